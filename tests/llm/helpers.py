"""Small inputs and brute-force versions for the text operators."""

import re

import duckdb

SMOKE = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def smoke_rows():
    return duckdb.connect().sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SMOKE}/documents.parquet'").fetchall()


def docs(spark, texts, first=0):
    rows = [(first + i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


#: NULLs, empty and blank texts, ties, control characters and a long text.
ODD = [None, "", "   ", "\n\t\x0b", "one", "one two", "One TWO", "same text here", "same text here",
       "é À ÀB ẞ", "a\x1cb\x85c\xa0d", "x" * 5000, " ".join(f"w{i}" for i in range(3000)),
       "<|endoftext|> and <|startoftext|>", "'s I'LL don't 12 3.5 !!", "😀 日本語 текст"]


def components(pairs, ids):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {i: find(i) for i in ids}


def shingles(text, width):
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def near_components(rows, width, percent):
    sets = {d: shingles(t, width) for d, t in rows}
    ids = sorted(sets)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, components(pairs, ids)
