"""Small tables with the awkward cases, and brute-force versions of the operators."""

import re
import zlib

import numpy as np

DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark, extra_rows=()):
    """Nulls in every column, empty and very long texts, repeated rows, clashing column names."""
    long_text = " ".join(f"word{i % 977} and number {i}" for i in range(30_000))
    rows = [(1, "plain words in one line that is long enough", "en", "a", 43), (2, None, None, None, None),
            (3, "", "en", "a", 0), (None, "a text without an id, all the same a text", "de", None, 1),
            (4, long_text, "en", "b", len(long_text)), (5, "tie", "fr", "b", 3), (6, "tie", "fr", "b", 3),
            (7, "the same row twice over, word for word", "en", "c", 5),
            (7, "the same row twice over, word for word", "en", "c", 5), *extra_rows]
    df = spark.createDataFrame(rows, DOC_DDL)
    for name in ("k", "h", "node", "form", "line", "exact", "near", "row", "all", "token", "count", "trusted",
                 "spans", "uid", "id", "component_id", "label", "keep"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def write_tables(spark, folder, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def smallest_reachable(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def within_one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if a == b:
        return True
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] or a[i + 1:] == b[i:] or a[i:] == b[i + 1:]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def prose(rng, n, vocabulary=400):
    return " ".join("".join(chr(97 + int(x)) for x in np.random.default_rng(w).integers(0, 26, 3 + w % 6))
                    for w in rng.integers(0, vocabulary, n))
