"""Line-first cleaning: drop lines that fail a rule, then reject texts that lost too much.

A line (cut at ``\\n``) without a word is neither judged nor counted. A worded line fails if any holds:

* *marks*: at least ``MARKS`` of its word characters are symbols ``#*$%&|<>``;
* *shouting*: it ends with a double exclamation mark, or most words do;
* *navigation*: ``SEPARATORS`` or more stand-alone separators (``|``, ``>``, ``»``, ``·``);
* *boilerplate*: it contains one of ``BOILERPLATE`` in lower case;
* *stutter*: four or more words of which at most a quarter are different.

A text is kept if its base figures pass (at least ``MIN_WORDS`` words; at most half of them in
three-word windows found twice) and the failed lines hold at most ``MAX_LOST`` of its word
characters. Null and empty texts have no words and are rejected. Rows are judged one by one:
repeated rows each get a row, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from trackframe.llm.common import texts
from trackframe.llm.words import TextBatch, dup_lines, repeat_words, slices

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Percent of a line's word characters that may be symbols, and of a text's that lines may lose.
MARKS = 10
MAX_LOST = 30
SEPARATORS = 3
BOILERPLATE = (
    "cookie", "javascript", "lorem ipsum", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "sign in", "log in", "subscribe", "newsletter", "click here", "read more", "share this", "skip to content", "back to top",
)

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "n_failed_lines long, lost_chars long"
)
_SYMBOLS = tuple(bytes([c]) for c in b"#*$%&|<>")
_SEPARATORS = {b"|", b">", "»".encode(), "·".encode()}
_BOILERPLATE = [x.encode() for x in BOILERPLATE]
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def line_fails(line: bytes, words: list[bytes]) -> bool:
    """Whether a worded line breaks a rule."""
    chars = len(b"".join(words).decode("utf-8"))
    if 100 * sum(map(line.count, _SYMBOLS)) >= MARKS * chars:
        return True
    if words[-1].endswith(b"!!") or 2 * sum(w.endswith(b"!!") for w in words) > len(words):
        return True
    if sum(w in _SEPARATORS for w in words) >= SEPARATORS:
        return True
    lower = line.translate(_LOWER)
    if any(x in lower for x in _BOILERPLATE):
        return True
    return len(words) >= 4 and 4 * len(set(words)) <= len(words)


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document: the base figures, the verdict, and the text without its failed lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            stats = TextBatch(batch.column("text"))
            rows, cleaned = [], []
            for i, raw in enumerate(stats.raw):
                lines = raw.split(b"\n")
                words = raw.split()
                left, failed, lost = [], 0, 0
                for line in lines:
                    own = line.split()
                    if own and line_fails(line, own):
                        failed += 1
                        lost += len(b"".join(own).decode("utf-8"))
                    else:
                        left.append(line)
                repeated = repeat_words(words)
                base = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * len(words)
                chars = int(stats.word_chars[i])
                kept = not base and 100 * lost <= MAX_LOST * chars
                rows.append((len(words), chars, int(stats.symbols[i]), dup_lines(lines), repeated, base, kept, failed, lost))
                if with_text:
                    cleaned.append(b"\n".join(left).decode("utf-8"))
            columns = list(map(pa.array, zip(*rows)))
            names = [x.split()[0] for x in COLUMNS.split(", ")]
            if with_text:
                columns.append(pa.array(cleaned, pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names, *["text"] * with_text])

    schema = f"doc_id long, {COLUMNS}" + ", text string" * with_text
    return texts(docs, id_col, text_col).mapInArrow(run, schema)


# The same figures in SQL. Words, lines and three-word windows are unnested; nothing is left out.
SQL = r"""
with d as (select doc_id, coalesce(text, '') as text from documents),
ln as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as no from d),
lw as (select *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as ws from ln),
lf as (
    select *, len(array_to_string(ws, '')) as chars, lower(line) as low,
           len(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) as marks
    from lw where len(ws) > 0),
judged as (
    select doc_id, line, no, chars,
        100 * marks >= {marks} * chars
        or suffix(ws[-1], '!!') or 2 * len(list_filter(ws, lambda w: suffix(w, '!!'))) > len(ws)
        or len(list_filter(ws, lambda w: w in ('|', '>', '»', '·'))) >= {separators}
        or {boilerplate}
        or (len(ws) >= 4 and 4 * len(list_distinct(ws)) <= len(ws)) as failed
    from lf),
lost as (
    select doc_id, count(*) - count(distinct line) as n_dup_lines, count(*) filter (failed) as n_failed_lines,
           coalesce(sum(chars) filter (failed), 0)::bigint as lost_chars
    from judged group by doc_id),
w as (
    select doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as w,
           generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) as i from d),
g as (select doc_id, i, w, w || ' ' || lead(w, 1) over o || ' ' || lead(w, 2) over o as g from w window o as (partition by doc_id order by i)),
c as (select doc_id, i, w, case when g is null then 0 else count(*) over (partition by doc_id, g) end as n from g),
r as (select doc_id, w, max(n) over (partition by doc_id order by i rows between 2 preceding and current row) >= 2 as again from c),
s as (select doc_id, count(*) as n_words, sum(len(w))::bigint as word_chars, count(*) filter (again) as n_repeat_words from r group by doc_id),
f as (
    select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
           len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
           coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_failed_lines, 0) as n_failed_lines,
           coalesce(lost_chars, 0) as lost_chars
    from d left join s using (doc_id) left join lost using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {min_words} or 100 * n_repeat_words > {repeat} * n_words as base_failed,
       not (n_words < {min_words} or 100 * n_repeat_words > {repeat} * n_words) and 100 * lost_chars <= {lost} * word_chars as kept,
       n_failed_lines, lost_chars
from f""".format(
    marks=MARKS, separators=SEPARATORS, min_words=MIN_WORDS, repeat=MAX_REPEAT_PERCENT, lost=MAX_LOST,
    boilerplate=" or ".join(f"contains(low, '{x}')" for x in BOILERPLATE),
)
