"""trackframe: labelled, cleaned, windowed datasets from recorded updates, on Spark."""

from trackframe.spec import DatasetSpec, FeatureSpec, TRACK, TRACK_VOCABULARY, Vocabulary

__all__ = ["DatasetSpec", "FeatureSpec", "TRACK", "TRACK_VOCABULARY", "Vocabulary"]
