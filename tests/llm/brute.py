"""Plain versions of the operators, over Python lists, and rows that are hard to handle."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Nulls, empty and blank texts, one word, ties, exact copies, long runs, control characters, other scripts.
EDGES = [
    (None, "a row without an id"), (None, None), (900, None), (901, ""), (902, "  \n\t "), (903, "one"), (904, "ONE"), (905, "a b c"),
    (906, "a b c d"), (907, "a b c d"), (908, "x" * 5000), (909, "ab " * 1500), (910, "a\n\n\n\nb"), (911, "\x00\x1c\x85  é́ 你好 😀 ΑΣ"),
    (912, "<|endoftext|>a<|startoftext|> b"), (913, "line one here.\nline two here.\nline three here.\n" * 3), (914, "it's  we'll  İ ſ ½ ２"),
]


def frame(spark, rows, ids="doc_id", clash=()):
    """Documents of (id, text), with more columns of names that operators use inside."""
    schema = ", ".join([f"{ids} long, text string", *(f"{c} string" for c in clash)])
    return spark.createDataFrame([(*r, *["clash"] * len(clash)) for r in rows], schema)


def union_find(n):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    return parent, find


def jaccard(rows, width, percent):
    """(id, set size, smallest linked id) of every row."""
    sets = []
    for _, text in rows:
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append(set() if not words else {tuple(words)} if len(words) < width else {tuple(words[i : i + width]) for i in range(len(words) - width + 1)})
    parent, find = union_find(len(rows))
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            both = len(sets[i] & sets[j])
            if both and rows[i][0] is not None and rows[j][0] is not None and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted(((d, len(sets[i]), low[find(i)] if d is not None else None) for i, (d, _) in enumerate(rows)), key=str)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def repeated_bytes(rows, depth):
    """(id, bytes, removed, runs, digest of the rest) of every row; ids must be unique."""
    seen, out = set(), []
    for doc, text in in_order(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - depth + 1):
            if raw[s : s + depth] in seen:
                gone[s : s + depth] = b"\1" * depth
            seen.add(raw[s : s + depth])
        runs = sum(1 for i in range(len(gone)) if gone[i] and (not i or not gone[i - 1]))
        rest = bytes(x for x, y in zip(raw, gone) if not y)
        out.append((doc, len(raw), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def repeated_lines(rows, run, least_words=50):
    """(id, text without repeated runs of lines, lines removed); ids must be unique."""
    seen, out = set(), []
    for doc, text in in_order(rows):
        lines = (text or "").split("\n")
        worded = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for s in range(len(worded)):
            for width in range(1, min(run, len(worded) - s) + 1):
                key = tuple(lines[i].strip(" \t\n\x0b\x0c\r") for i in worded[s : s + width])
                if width < run and sum(len(WORD.findall(x)) for x in key) < least_words:
                    continue
                if key in seen:
                    gone.update(worded[s : s + width])
                seen.add(key)
        out.append((doc, None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)))
    return sorted(out, key=str)
