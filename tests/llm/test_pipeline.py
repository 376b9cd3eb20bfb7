"""The pipeline's stages against brute-force versions of what they decide."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from foliary.llm import simhash, toxicity
from foliary.llm.queries import vocabulary


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows of documents, and of what each stage gives."""
    now = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [now]
    for _, stage in cp.STAGES:
        now = spark.createDataFrame(stage(spark, now, sf_dir).toPandas())
        out.append(now)
    return out


def texts(df) -> dict:
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns


def test_toxic_documents_go(spark, sf_dir, stages):
    docs, left = texts(stages[0]), texts(stages[1])
    model = toxicity.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert left == {i: t for i, t in docs.items() if model.score([t])[0] < cp.TOXIC_FROM}


def test_one_of_each_group_stays(stages):
    docs, left = texts(stages[1]), texts(stages[2])
    sets = {i: set(simhash.hashes(t, cp.WORDS).tolist()) for i, t in docs.items()}
    group = {i: i for i in docs}
    for a in sorted(docs):
        for b in sorted(docs):
            if b < a and len(sets[a] & sets[b]) >= cp.SIMILARITY * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    assert left == {i: t for i, t in docs.items() if group[i] == i}


def test_repeats_are_cut(stages):
    docs, left = texts(stages[2]), texts(stages[3])
    n = cp.REPEAT_BYTES
    raw = {i: t.encode() for i, t in docs.items()}
    seen: dict[bytes, int] = {}
    for b in raw.values():
        for k in range(len(b) - n + 1):
            seen[b[k : k + n]] = seen.get(b[k : k + n], 0) + 1
    want = {}
    for i, b in raw.items():
        keep = np.ones(len(b), bool)
        for k in range(len(b) - n + 1):
            if seen[b[k : k + n]] > 1:
                keep[k : k + n] = False
        kept = np.frombuffer(b, np.uint8)[keep].tobytes().decode("utf-8", "ignore")
        if keep.all() or kept.strip(" "):
            want[i] = kept
    assert left == want
    assert stages[3].where(F.length("text") != F.col("n_chars")).count() == 0


def test_mixing_samples(stages):
    before, after = stages[3], stages[4]
    assert after.join(before, after.columns, "left_anti").count() == 0
    assert 0.5 * before.count() < after.count() <= before.count()
    import tokenizers

    lib = tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    n = {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in texts(before).items()}
    kept = sum(n[i] for i in texts(after))
    assert abs(kept / sum(n.values()) - cp.TOKEN_BUDGET) < 0.15


def test_token_ids(stages):
    import tokenizers

    lib = tokenizers.Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    docs = texts(stages[4])
    for r in stages[5].collect():
        assert list(np.frombuffer(bytes(r["ids"]), "<u4")) == lib.encode(docs[r["doc_id"]], add_special_tokens=False).ids
    assert stages[5].count() == len(docs)


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, tmp_path, empty):
    """Nulls in any column, empty and long texts, repeated rows, extra columns; and no rows at all."""
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(9000))
    rows = [(1, "a b c d e f", "en", "s", 11, "x"), (1, "a b c d e f", "en", "s", 11, "x"), (2, None, None, None, None, None), (3, "", "en", "s", 0, "x"), (None, "no id here at all", None, "s", 17, "x"), (4, long, "fr", None, len(long), None), (5, long + " tail", "fr", "t", len(long) + 5, "x")]
    df = spark.createDataFrame([] if empty else rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in cp.STAGES:
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        before, now = now, spark.read.parquet(f"{tmp_path}/{name}")
        assert name == "bpe" or now.columns == before.columns
    ids = [r["doc_id"] for r in now.collect()]
    assert not ids if empty else None in ids and ids.count(1) <= 1 and 5 not in ids
