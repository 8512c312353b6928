"""The corpus pipeline, stage by stage, against brute-force versions."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import packing, secret_scan

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(9)
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    words = WORD.findall(" ".join(t for _, t, _, _ in rows[:40]))
    shared = " ".join(rng.choices(words, k=110))
    for k in range(12):
        rows.append((7000 + k, " ".join(rng.choices(words, k=200)) + "\n" + shared + "\n" + " ".join(rng.choices(words, k=200)), "en", "src0"))
    rows += [(7100, None, None, None), (7101, "", "en", "src0"), (7102, "key password = hunter2hunter2 " + " ".join(rng.choices(words, k=80)), "en", "src1"),
             (None, " ".join(rng.choices(words, k=90)), "en", None), (7103, "ab " * 4000, "en", "src0"), (7000, rows[-1][1], "en", "src0")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    path = str(tmp_path_factory.mktemp("sf"))
    df.repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


def rows_of(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def near_groups(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {i for i, (doc_id, _) in enumerate(rows) if least.get(find(i)) == doc_id}


def without_repeats(texts, span=400, words=51):
    """Strings of ``span`` bytes and of ``words`` words that occur twice are cut out."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + span] for b in data for p in range(len(b) - span + 1))
    spans = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)] for b in data]
    pieces = [[(s[i][0], s[i + words - 1][1]) for i in range(len(s) - words + 1)] if words else [] for s in spans]
    passages = Counter(b[lo:hi] for b, p in zip(data, pieces) for lo, hi in p)
    out = []
    for t, b, p in zip(texts, data, pieces):
        mask = np.zeros(len(b), bool)
        for lo in range(len(b) - span + 1):
            if seen[b[lo : lo + span]] > 1:
                mask[lo : lo + span] = True
        for lo, hi in p:
            if passages[b[lo:hi]] > 1:
                mask[lo:hi] = True
        out.append(np.frombuffer(b, np.uint8)[~mask].tobytes().decode("utf-8", "ignore") if mask.any() else t)
    return out


def test_stages_equal_brute_force(spark, table):
    docs = spark.read.parquet(f"{table}/documents.parquet")
    columns = docs.columns
    quality, near, repeats, secrets, pack = (f for _, f in corpus_pipeline.STAGES)

    kept = spark.createDataFrame(quality(spark, docs, table).collect(), docs.schema)
    assert kept.columns == columns
    before, after = rows_of(docs), rows_of(kept)
    assert not after - before and sum(after.values()) > 0.5 * sum(before.values())
    assert all(len(WORD.findall(t or "")) >= 10 for _, t in after)

    one = spark.createDataFrame(near(spark, kept, table).collect(), docs.schema)
    rows = [(i, t) for (i, t), k in after.items() for _ in range(k)]
    assert one.columns == columns and set(rows_of(one)) == {rows[i] for i in near_groups(rows)}

    cut = spark.createDataFrame(repeats(spark, one, table).collect(), docs.schema)
    rows = [(r.doc_id, r.text) for r in one.collect()]
    want = Counter((i, t) for (i, _), t in zip(rows, without_repeats([t for _, t in rows])) if t.strip())
    assert cut.columns == columns and rows_of(cut) == want
    assert cut.where("n_chars != length(text)").count() == 0

    clean = secrets(spark, cut, table)
    assert clean.columns == columns and rows_of(clean) == Counter((i, secret_scan.redact(t)) for (i, t), k in want.items() for _ in range(k))

    pieces = pack(spark, clean, table).collect()
    texts = [t for _, t in rows_of(clean).elements()]
    words = packing._tokens(packing._default_path())
    assert sum(p.length for p in pieces) == sum(len(x) + 1 for x in words.encode_all(texts))


def test_run_and_empty_table(spark, table, tmp_path):
    pieces = corpus_pipeline.run(spark, table)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(pieces.columns) and pieces.count() > 0
    empty = str(tmp_path)
    spark.read.parquet(f"{table}/documents.parquet").where("false").write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{table}/labels.parquet").where("false").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_passages_of_more_than_50_words_are_cut(spark):
    rng = random.Random(14)

    def words(n, size):
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=size)) for _ in range(n))

    rows = [(100 + k, words(rng.randrange(40, 120), 6)) for k in range(20)] + [(200, "ab " * 60), (201, "xy zz " * 25), (202, None), (None, words(51, 7))]
    for k, passage in enumerate((words(51, 5), words(51, 1), words(50, 5), words(55, 4) + "\n" + words(30, 2))):
        rows += [(10 * k + i, f"{words(60, 6)}\n{passage} {words(60, 6)}") for i in range(3)]
    rows += rows[-1:]
    data = [(t or "").encode() for _, t in rows]
    spans = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)] for b in data]
    pieces = [[(s[i][0], s[i + 50][1]) for i in range(len(s) - 50)] for s in spans]
    seen = Counter(b[lo:hi] for b, p in zip(data, pieces) for lo, hi in p)
    texts = without_repeats([t for _, t in rows], words=0)  # by 400 bytes alone
    want = Counter()
    for (doc_id, text), b, p in zip(rows, data, pieces):
        mask = np.zeros(len(b), bool)
        for lo in range(len(b) - 399):
            if sum(b[lo : lo + 400] in other for other in data) > 1:
                mask[lo : lo + 400] = True
        for lo, hi in p:
            if seen[b[lo:hi]] > 1:
                mask[lo:hi] = True
        left = np.frombuffer(b, np.uint8)[~mask].tobytes().decode() if mask.any() else text
        if not mask.any() or left.strip():
            want[doc_id, left] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = rows_of(corpus_pipeline.repeated_passages(spark, docs, ""))
    assert got == want
    assert want != Counter(zip([i for i, _ in rows], texts))
