import textwrap

from tests.llm.brute import EDGES, frame
from trackframe.llm import license_scan as scan


def plain(raw, threshold=80):
    """Best Dice of all spans of lines with every template, and how many begin and end with its pairs."""
    lines = [w for x in raw.split(b"\n") if (w := scan.words_of(x))]
    out = {}
    for name, templates in scan.TEMPLATES.items():
        best, units = 0, set()
        for template in templates:
            words = scan.words_of(template.encode())
            own = scan.pairs_of(words)
            for i in range(len(lines)):
                for j in range(i, len(lines)):
                    span = [(w, k) for k in range(i, j + 1) for w in lines[k]]
                    if j > i and (len(span) - 1) * threshold > (len(words) - 1) * (200 - threshold):
                        break
                    pairs = scan.pairs_of([w for w, _ in span])
                    if pairs and 200 * len(pairs & own) >= threshold * (len(pairs) + len(own)):
                        best = max(best, 2 * len(pairs & own) / (len(pairs) + len(own)))
                        hits = [(a[1], b[1]) for a, b in zip(span, span[1:]) if (a[0], b[0]) in own]
                        if i in {a for a, _ in hits} and j in {b for _, b in hits}:
                            units.add((i, j))
        if best:
            out[name] = (round(best, 6), len(units))
    return out


def test_bounds_lose_no_match(spark):
    rows = list(EDGES)
    for i, (name, templates) in enumerate(sorted(scan.TEMPLATES.items())):
        for k, template in enumerate(templates):
            words = template.split()
            rows += [(i * 10 + k, f"Some prose here.\n{template}\nMore."), (i * 10 + k + 5, "\n".join([template[:40], template[40:]]) + "\n\nEnd."),
                     (1000 + i * 10 + k, " ".join(words[: max(3, len(words) * 9 // 10)]).upper()), (2000 + i * 10 + k, " ".join(words[::2]))]
    got = scan.scan_licences(frame(spark, rows, clash=("dice", "licence"))).collect()
    want = sorted(((d, n, *s) for d, t in rows for n, s in plain((t or "").encode()).items()), key=str)
    assert sorted(((r.doc_id, r.licence, r.dice, r.n_units) for r in got), key=str) == want
    assert {r.licence for r in got} == set(scan.TEMPLATES)
    assert scan.scan_licences(frame(spark, [])).count() == 0


def test_licences_of_several_paragraphs_inside_prose(spark):
    """Each whole template, in wrapped lines and paragraphs, between other text."""
    prose = "\n".join(f"A line of prose number {i} about the sea and the use of boats in it." for i in range(30))
    rows, names = [], {}
    for name, templates in scan.TEMPLATES.items():
        whole = textwrap.wrap(templates[-1], 72)
        cuts = [whole[i : i + 4] for i in range(0, len(whole), 4)]
        text = prose + "\n\nCopyright 2020 Somebody\n\n" + "\n\n".join("\n".join(x) for x in cuts) + "\n\n" + prose
        names[len(rows)] = name
        rows.append((len(rows), text))
    got = scan.scan_licences(frame(spark, rows)).collect()
    found = {(r.doc_id, r.licence): (r.dice, r.n_units) for r in got}
    assert all(found[i, name][0] == 1.0 for i, name in names.items() if name != "proprietary")
    assert found == {(d, n): s for d, t in rows for n, s in plain(t.encode()).items()}


def test_texts_of_many_lines(spark):
    """Copies of a short template, one long line of it, and a licence behind 20,000 lines."""
    mit = "\n\n".join(textwrap.wrap(scan.TEMPLATES["MIT"][-1], 200))
    rows = [(1, "All rights reserved.\n" * 20_000), (2, "All rights reserved. " * 20_000), (3, "the use of the sea\n" * 20_000 + mit)]
    got = {(r.doc_id, r.licence): (r.dice, r.n_units) for r in scan.scan_licences(frame(spark, rows)).collect()}
    assert got[1, "proprietary"] == (1.0, 20_000) and got[2, "proprietary"] == (0.8, 1) and got[3, "MIT"][0] == 1.0 and len(got) == 3


def test_units_and_repeated_rows(spark):
    text = "Released under the MIT License.\nNothing else is said here.\nReleased under the MIT License."
    got = scan.scan_licences(frame(spark, [(None, text), (1, text), (1, text)])).collect()
    assert [(r.licence, r.n_units, r.dice) for r in got] == [("MIT", 2, 1.0)] * 3
