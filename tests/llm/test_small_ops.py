"""Packing, suffix dedup, Jaccard join, line dedup and personal data against brute force."""

import hashlib
import math
import random
import re
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import helpers as H  # noqa: E402

from orchard.llm import line_dedup, ngram_join, packing, pii, suffix_dedup  # noqa: E402


def documents(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


# ---- packing --------------------------------------------------------------------------------

def test_packing_pieces_and_places(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    rng = np.random.default_rng(1)
    texts = ["", "it's don't DON'T naïve Ünïcode… a—b 12,345.67 <|endoftext|>x x'll",
             "a.b,c!d... (e) \t tab nbsp   em İstanbul ΣΑΣ é ́x ﬁ",
             *[H.prose(rng, int(n)) for n in rng.integers(1, 900, 60)], H.prose(rng, 9000)]
    got = packing.pack(documents(spark, texts), with_ids=True).toPandas()
    for doc, part in got.groupby("doc_id"):
        want = np.array(tok.encode(texts[doc], add_special_tokens=False).ids + [0], "<u4")
        part = part.sort_values("piece")
        assert np.concatenate(part["ids"].tolist()).tolist() == want.tolist()
        assert part["start"].tolist() == list(range(0, len(want), 2048))
        assert [zlib.crc32(want[s:s + 2048].tobytes()) for s in part["start"]] == part["ids_crc32"].tolist()
        assert (part["length"].to_numpy()[:-1] == 2048).all()
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        assert seq["offset"].tolist() == (seq["length"].cumsum() - seq["length"]).tolist()
        assert seq["length"].sum() <= 2048
    small = got.loc[got["length"] < 2048, "length"].to_numpy()
    bound = packing.bin_lower_bound(np.bincount(small, minlength=2049)) + (got["length"] == 2048).sum()
    assert got["sequence_id"].nunique() <= bound + 1
    seqs = packing.sequences(packing.pack(documents(spark, texts), with_ids=True)).toPandas()
    assert sum(map(len, seqs["ids"])) == got["length"].sum()


@pytest.mark.parametrize("seed", range(4))
def test_lower_bound_never_exceeds_best_packing(seed):
    rng = np.random.default_rng(seed)
    for _ in range(60):
        sizes = rng.integers(1, 21, rng.integers(1, 8))

        def fewest(items, rooms):
            if not items:
                return len(rooms)
            best = len(rooms) + len(items)
            for i, r in enumerate(rooms):
                if r >= items[0] and r not in rooms[:i]:
                    best = min(best, fewest(items[1:], rooms[:i] + [r - items[0]] + rooms[i + 1:]))
            return min(best, fewest(items[1:], rooms + [20 - items[0]]))

        exact = fewest(sorted(sizes.tolist(), reverse=True), [])
        assert packing.bin_lower_bound(np.bincount(sizes, minlength=21), 20) <= exact
        bins, offsets, n = packing.best_fit_decreasing(sizes, 20)
        assert exact <= n and np.bincount(bins, sizes).max() <= 20


def test_exchange_keeps_every_piece_once(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, int(x)) for i, x in enumerate(rng.integers(300, 1100, 900))], "uid long, length long")
    got = packing.pack_lengths(df, per_part=100).join(df, "uid").toPandas()
    assert sorted(got["uid"]) == list(range(900))
    assert got.groupby("sequence_id")["length"].sum().max() <= 2048
    alone = packing.pack_lengths(df, per_part=100, exchanges=0).select("sequence_id").distinct().count()
    assert got["sequence_id"].nunique() <= alone


# ---- suffix dedup ---------------------------------------------------------------------------

def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_matches_brute_force(spark, tmp_path):
    rng = np.random.default_rng(2)
    shared = [H.prose(rng, n) for n in (60, 80, 120, 300)]
    texts = [None, "", "short", "ab" * 700, "ab" * 900 + "c", shared[3], shared[3]]
    for i in range(40):
        p = shared[i % 4]
        cut = int(rng.integers(0, 40))
        texts.append(H.prose(rng, 50, 5000) + p[cut:] + "é" * (i % 3) + H.prose(rng, 30, 5000) + p[:len(p) - cut])
    H.write_tables(spark, tmp_path, documents=documents(spark, texts).repartition(3))
    got = suffix_dedup.op10_suffix_dedup(spark, str(tmp_path)).toPandas().sort_values("doc_id")
    want = brute_repeats(texts, 400)
    assert list(zip(got["n_bytes"], got["n_removed"], got["n_spans"], got["kept_sha256"])) == want
    full = suffix_dedup.remove_repeats(documents(spark, texts)).toPandas()
    assert all(sum(s["end"] - s["start"] for s in r.spans) + len(r.kept) == r.n_bytes for r in full.itertuples())


def brute_passages(texts, words):
    """Maximal runs of windows of ``words`` words that another row has too; a copied text is one."""
    bags = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    owners = {}
    for d, ws in enumerate(bags):
        for i in range(len(ws) - words + 1):
            owners.setdefault(tuple(ws[i:i + words]), set()).add(texts[d])
    out = []
    for d, ws in enumerate(bags):
        if texts.count(texts[d]) > 1:
            out.append(int(len(ws) >= words))
            continue
        at = [len(owners[tuple(ws[i:i + words])]) > 1 for i in range(len(ws) - words + 1)]
        out.append(sum(a and not b for a, b in zip(at, [False, *at])))
    return out


def test_passages_of_many_words_are_found_below_400_bytes(spark, tmp_path):
    rng = np.random.default_rng(12)

    def short(n):
        return " ".join("abcdefghij"[int(x)] + "klmnop"[int(y)] for x, y in zip(rng.integers(0, 10, n), rng.integers(0, 6, n)))

    shared = [short(51), short(70), short(50)]              # the last one is a word too short
    texts = [None, "", "a b", shared[0], "  " + short(60) + "\t", *[short(40) + " " + shared[i % 3] + "\n" + short(30) + "  "
             + shared[(i + 1) % 3] for i in range(12)], short(200)]
    texts += [texts[-1], short(120) + " " + shared[1], shared[0] + " " + shared[0]]
    H.write_tables(spark, tmp_path, documents=documents(spark, texts).repartition(3))
    got = suffix_dedup.op10_suffix_dedup(spark, str(tmp_path)).toPandas().sort_values("doc_id")
    assert got["n_passages"].tolist() == brute_passages(texts, 51)
    assert got.loc[[3], "n_removed"].item() == 0 and got["n_passages"].sum() > 12
    assert list(zip(got["n_bytes"], got["n_removed"], got["n_spans"], got["kept_sha256"])) == brute_repeats(texts, 400)


def test_lengths_that_distances_cannot_hold_are_refused(spark):
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(documents(spark, ["a"]), length=2000)
    long = H.prose(np.random.default_rng(3), 800)
    got = suffix_dedup.remove_repeats(documents(spark, [long + "x", "y" + long]), length=2000, gram=1024).collect()
    assert all(r.n_bytes - len(r.kept) == len(long) for r in got)


# ---- Jaccard join ---------------------------------------------------------------------------

@pytest.mark.parametrize("group, pivot_from", [(2000, 256), (7, 256), (7, 3), (2000, 1)])
def test_jaccard_classes_match_brute_force(spark, group, pivot_from):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(300)}" for _ in range(rng.choice([1, 3, 5, 9, 30, 60, 120]))] for _ in range(25)]
    texts = [None, "", " \t\n", "one", "ONE", "one two", "a b c d e", "A  b\nc d e"]
    for _ in range(140):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(900)}"
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    got = ngram_join.jaccard_classes(documents(spark, texts).repartition(4), group=group,
                                      pivot_from=pivot_from).toPandas().set_index("doc_id")
    sets = [H.shingles(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = H.smallest_reachable(range(len(texts)), links)
    assert got["n_shingles"].to_dict() == {i: len(s) for i, s in enumerate(sets)}
    assert got["component_id"].to_dict() == want
    kept = ngram_join.keep_one(documents(spark, texts)).toPandas()["doc_id"]
    assert sorted(kept) == sorted(set(want.values()))


# ---- line dedup -----------------------------------------------------------------------------

def test_line_dedup_matches_sql_and_brute_force(spark, tmp_path):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdé fgh") for _ in range(rng.choice([19, 20, 21, 25, 33, 40, 128, 129, 257, 400])))
            for _ in range(50)]

    def edited(t):
        i, c = rng.randrange(len(t)), rng.choice("xyzéQ")
        return rng.choice([t[:i] + c + t[i + 1:], t[:i] + c + t[i:], t[:i] + t[i + 1:]])

    texts = []
    for _ in range(120):
        lines = [rng.choice(base) for _ in range(rng.randint(0, 6))]
        texts.append("\n".join(edited(edited(x)) if rng.random() < 0.3 else edited(x) if rng.random() < 0.5 else x
                               for x in lines))
    H.write_tables(spark, tmp_path, documents=documents(spark, texts).repartition(3))
    got = line_dedup.op6_line_dedup(spark, str(tmp_path)).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    sql = con.execute(line_dedup.OP6_SQL).df().sort_values("doc_id").reset_index(drop=True)
    assert got.equals(sql[got.columns])
    seen, exact, near = [], 0, 0
    for t in texts:
        for x in t.split("\n"):
            form = x.strip(" ").lower()
            if len(form) >= 20:
                exact += form in seen
                near += form not in seen and any(H.within_one_edit(form, y) for y in seen)
                seen.append(form)
    assert (got["n_exact"].sum(), got["n_near"].sum()) == (exact, near) and near > 20


def test_exact_repeats_of_short_lines_go(spark):
    texts = ["les.\n\nA line that is long enough to count", " LES. \n\nlet.\nx", "x\nles.\nles", "Les."]
    got = line_dedup.dedup_lines(documents(spark, texts)).toPandas().set_index("doc_id").sort_index()
    assert got["text"].tolist() == [texts[0], "\nlet.\nx", "les", ""]      # blank lines and near ones stay
    assert [(x["n"], x["exact"], x["near"]) for x in got["lines"]] == [(3, 0, 0), (4, 1, 0), (3, 2, 0), (1, 1, 0)]


# ---- personal data --------------------------------------------------------------------------

# The patterns as specified.
SPEC = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in double) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": all(int(p) <= 255 for p in match.split(".")) if kind == "ip" else False,
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def test_base_spans_match_the_patterns(spark, tmp_path):
    rng = random.Random(6)
    parts = ["a@b.co", "a@b.c_d@e.f", "x..y%+-@a-b.c-d.e", "@", "a@b", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.002.255.0255",
             "4225039295678253", "4225-0392 9567 8253", "4111 1111 1111 1111", "4111 1111 1111 1112", "+1 (386) 555-3733", "+1 2",
             "++49 (30) 1234.5678-9", "é", "😀", " ", ",", "\n", "word", "7", "12 34"]
    texts = [None, "", "9" * 20_000, "a" * 20_000, "1." * 5_000, "a@b" + ".c" * 5_000, "+1" + " " * 5_000]
    texts += ["".join(rng.choice(parts) + rng.choice(["", " ", "-"]) for _ in range(rng.randint(1, 25))) for _ in range(300)]
    H.write_tables(spark, tmp_path, documents=documents(spark, texts).repartition(3))
    got = pii.op7_pii(spark, str(tmp_path)).toPandas().set_index("doc_id")
    for i, t in enumerate(texts):
        spans = [(k, m.start(), m.end()) for k, p in SPEC.items() for m in re.finditer(p, t or "") if valid(k, m.group())]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        row = got.loc[i]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (i, t[:80], joined, row["spans"])
        assert [row[f"n_{k}"] for k in SPEC] == [sum(s[0] == k for s in spans) for k in SPEC]


def test_telling_terms_become_spans_and_are_replaced(spark):
    rng = np.random.default_rng(9)
    texts = [H.prose(rng, 40) for _ in range(60)]
    for i in range(5):      # a word that is seen with one address only, in five different texts
        texts[i] = f"{H.prose(rng, 4)} zanzibar {H.prose(rng, 3)} boss@corp.example {H.prose(rng, 5)}"
    docs = documents(spark, texts)
    found = pii.find_personal(docs).toPandas().set_index("doc_id")["spans"]
    terms = {texts[i][s["start"]:s["end"]] for i in found.index for s in found[i] if s["kind"] == "term"}
    assert terms == {"zanzibar"}
    clean = pii.sanitise(docs).toPandas().set_index("doc_id")["text"]
    assert all("zanzibar" not in clean[i] and "boss" not in clean[i] and "[EMAIL]" in clean[i] for i in range(5))
    assert all(clean[i] == texts[i] for i in range(5, 60))


def test_shares_use_the_number_of_units(spark):
    rng = np.random.default_rng(21)
    texts = [H.prose(rng, 40, 30) for _ in range(120)]     # few, frequent words: all of them are candidates
    planted = {"zanzibar": 8, "fernando": 9, "quartz": 14}      # units with the word; the address has the first 8
    for i in range(14):
        texts[i] += "".join(f" {w}" for w, n in planted.items() if i < n) + (" boss@corp.example" if i < 8 else "")
    rows = pii.find_personal(documents(spark, texts + texts[:3])).toPandas().set_index("doc_id")["spans"]
    got = {texts[i][s["start"]:s["end"]]: s["share"] for i in range(len(texts)) for s in rows[i] if s["kind"] == "term"}
    share = {w: math.log(len(texts) / n) / math.log(len(texts) / 8) for w, n in planted.items()}
    assert share["quartz"] < pii.GENERALISE < share["fernando"]
    assert got == {w: pytest.approx(share[w]) for w in ("zanzibar", "fernando")}


def test_packing_encodes_texts_in_small_runs(monkeypatch):
    import numpy as np
    import pyarrow as pa
    from orchard.llm import packing
    assert packing.RUN_BYTES <= 400_000 and packing._CACHE_WORDS <= 250_000
    words = [f"w{i}" for i in range(400)]
    docs = [" ".join(words[k:k + 300]) for k in range(0, 100, 10)]
    data = np.frombuffer("".join(docs).encode(), np.uint8)
    off = np.cumsum([0] + [len(d) for d in docs])
    whole = [t.tolist() for t in packing._Encoder(packing.default_tokenizer()).encode(data, off)]
    monkeypatch.setattr(packing, "_CACHE_WORDS", 50)            # forgotten between any two runs
    enc = packing._Encoder(packing.default_tokenizer())
    batch = pa.record_batch([pa.array(range(len(docs))), pa.array(docs)], names=["doc_id", "text"])
    parts = [t.tolist() for _, d, o in packing.byte_batches([batch], 2_000) for t in enc.encode(d, o)]
    assert parts == whole
