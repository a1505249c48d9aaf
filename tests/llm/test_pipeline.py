"""Every stage over small tables against a plain version of its rule, row by row."""

import hashlib
import math
import re

import corpus_pipeline
import numpy as np
from conftest import TESTDATA as SMALLEST
from pyspark.sql import functions as F

from quotemill.llm import toxicity
from quotemill.llm.common import row_key

from .test_mixing import plain_mix
from .test_simhash import plain_classes, plain_fingerprint

#: The smallest tables have too few toxic documents to learn from.
TESTDATA = SMALLEST.replace("sf0.001", "sf0.01")


def plain_score(tagger, text):
    """Forward and backward sums word by word, then the fitted calibration."""
    words = re.findall(r"\w+", (text or "").lower())
    own = [np.array([1, math.exp(min(30, max(-30, tagger.emission(w))))]) for w in words]
    scale, chances = np.exp(tagger.moves), []
    ahead, behind = [], [np.ones(2)]
    for at, value in enumerate(own):
        state = value if at == 0 else (ahead[-1] @ scale) * value
        ahead.append(state / state.sum())
    for value in reversed(own[1:]):
        state = scale @ (behind[-1] * value)
        behind.append(state / state.sum())
    for before, after in zip(ahead, reversed(behind), strict=False):
        both = before * after
        chances.append(both[1] / both.sum())
    expected, most = sum(c for c in chances if c > 0.1), max(chances, default=0.0)
    facts = np.array([1.0, math.log1p(expected), most, math.log((expected + 0.05) / (len(words) + 5))])
    return 1 / (1 + math.exp(-float(facts @ tagger.calibration)))


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def leaks(text, passages):
    """Whether a stretch of 13 words, or of a whole shorter item, agrees in eight words of ten."""
    a = np.array(tokens(text))
    for passage in passages:
        b = np.array(tokens(passage))
        width = min(13, len(b))
        if not width or len(a) < width:
            continue
        same = (a[:, None] == b[None, :]).astype(int)
        rows, columns = len(a) - width + 1, len(b) - width + 1
        agree = sum(same[k : k + rows, k : k + columns] for k in range(width))
        if agree.max() >= (math.ceil(width * 0.8) if width >= 8 else width):
            return True
    return False


def plain_shards(rows, shards=40, slack=0.01):
    """(id, text, size, shard, slot) of every (id, text)."""
    digest = lambda text: int(hashlib.md5((text or "").encode()).hexdigest()[:15], 16)
    order = sorted((digest(text), i, len((text or "").encode()) + 16, text) for i, text in rows)
    target = sum(size for _, _, size, _ in order) / shards
    groups, offset = {}, 0
    for grp, _, size, _ in order:
        start, total = groups.get(grp, (offset, 0))
        groups[grp] = (start, total + size)
        offset += size
    out, offset, filled = [], 0, {}
    for grp, i, size, text in order:
        start, total = groups[grp]
        middle = start + total / 2 if total <= target * slack else offset + size / 2
        shard = min(math.floor(middle / target), shards - 1)
        out.append((i, text, size, shard, filled.get(shard, 0)))
        filled[shard] = filled.get(shard, 0) + 1
        offset += size
    return out


def plain_stage(spark, name, docs):
    """What the stage has to leave, as a list of tuples, and the columns these stand for."""
    rows = docs.collect()
    if name == "toxicity":
        tagger = toxicity.fit_toxicity(spark, docs, spark.read.parquet(f"{TESTDATA}/labels.parquet"))
        return [tuple(r) for r in rows if plain_score(tagger, r.text) < toxicity.THRESHOLD], docs.columns
    if name == "simhash_near_dedup":
        classes = plain_classes({r.doc_id: plain_fingerprint(r.text) for r in rows})
        return [tuple(r) for r in rows if classes[r.doc_id] == r.doc_id], docs.columns
    if name == "benchmark_decontamination":
        passages = [r.text for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()]
        return [tuple(r) for r in rows if not leaks(r.text, passages)], docs.columns
    if name == "mixing":
        keyed = docs.select("doc_id", "text", "lang", "source", F.struct(*row_key(docs.columns)).cast("string").alias("key")).collect()
        split = [re.findall(r"[^\x20\x09-\x0D]+", r.text or "") for r in keyed]
        out = []
        for at, words in plain_mix([(r.key, r.source, len(w)) for r, w in zip(keyed, split, strict=True)], 512):
            row = keyed[at]
            text = row.text if len(words) == len(split[at]) else " ".join(split[at][w] for w in words)
            out.append((row.doc_id, text, row.lang, row.source))
        return out, ["doc_id", "text", "lang", "source"]
    return plain_shards([(r.doc_id, r.text) for r in rows]), ["doc_id", "text", "size", "shard", "slot"]


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    columns, last = docs.columns, corpus_pipeline.STAGES[-1][0]
    for name, stage in corpus_pipeline.STAGES:
        want, told = plain_stage(spark, name, docs)
        before, docs = docs, corpus_pipeline.materialize(stage(spark, docs, TESTDATA), name)
        got = [tuple(r) for r in docs.select(*told).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr), name
        assert docs.columns == columns or name == last
        if name in ("toxicity", "benchmark_decontamination"):
            assert 0 < docs.count() < before.count(), name
    assert set(columns) | {"size", "shard", "slot"} == set(docs.columns)


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{TESTDATA}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.toxic(spark, docs, TESTDATA).select("doc_id").collect()}
    assert all(labels.get(r.doc_id) != 0 or r.doc_id in kept for r in docs.select("doc_id").collect())


def test_run_applies_all_stages(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, TESTDATA), name)
    whole = corpus_pipeline.run(spark, TESTDATA)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.select(*whole.columns).collect()))


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "mixing", "sharding",
    ]
