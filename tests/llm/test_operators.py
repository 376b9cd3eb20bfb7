"""Each operator against the library or a brute-force version, on small tables with nulls, empty and long texts, ties and repeats."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from foliary.llm import chat, media, mixing, near_copies, sharding, simhash, suffix_dedup, toxicity, winnowing
from foliary.llm.bpe import bpe_decode, bpe_encode, load
from foliary.llm.common import fresh_dir
from foliary.llm.components import connected_components
from foliary.llm.queries import ORACLE_SQL, QUERIES, vocabulary
from foliary.llm.token_counts import counter, token_counts
from foliary.llm.trees import BoostedTrees, isotonic
from foliary.llm.windows import rightmost_minima

tokenizers = pytest.importorskip("tokenizers")

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, ids string, size string, fp string, shard string"


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def prose(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice(["th", "er", "an", "ing", "é", "ou", "st"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def odd_texts() -> list:
    """Texts with all that is awkward; ids are their numbers."""
    r = random.Random(5)
    base = [prose(r, r.randint(1, 300)) for _ in range(40)]
    shared = prose(r, 90)
    near = base[0] + " tail"
    return [
        *base, base[3], base[3], near, None, "", " ", "\n\t ", "a", "A b", "<|endoftext|> <|startoftext|>x", "\x00\x1c\x85  ", "Σς ẞ ǅ 中文 😀👍🏽 é", "x" * 5000, shared + base[7], base[8] + " " + shared, base[9][:40] + shared + base[9][40:], "ab" * 700, prose(r, 4000),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", None, *["clash"] * 6) for i, t in enumerate(odd_texts())]
    rows += [(None, "no id", None, None, None, *["clash"] * 6), rows[5], rows[5]]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).persist()


@pytest.fixture(scope="module")
def table(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.collect()]


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return [r.asDict() for r in df.collect()]


def matched(rows, table, expect, key="doc_id"):
    """Rows and expectations as multisets."""
    assert Counter(map(repr, rows)) == Counter(repr(expect(i, t)) for i, t in table)


# --- 1 and 6 -------------------------------------------------------------------------------------


def test_bpe(docs, none, table):
    path = vocabulary("word_bpe_49k.json")
    lib = tokenizers.Tokenizer.from_file(path)
    got = bpe_decode(bpe_encode(docs, path), path)

    def expect(i, t):
        ids = lib.encode(t, add_special_tokens=False).ids
        return (i, len(ids), np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False))

    matched([(r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in got.collect()], table, expect)
    assert bpe_decode(bpe_encode(none, path), path).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_random(name):
    model, lib = load(vocabulary(name)), tokenizers.Tokenizer.from_file(vocabulary(name))
    r = random.Random(1)
    pool = "abcdehst  \t\n\r'''0123²Ⅷéè ÀσςİßΣ中😀👍🏽́‍!?._-<|>"
    for _ in range(3000):
        t = "".join(r.choice(pool) for _ in range(r.randint(0, 30)))
        assert list(np.frombuffer(model.encode_bytes(t), "<u4")) == lib.encode(t, add_special_tokens=False).ids, t
    for word in ("the" * 60, "aaaaaaaaaaaaaaaaaaaaaaa", "ingingin"):
        s = model.word_symbols(word)
        assert model.encode_symbols(s) == model.merges.by_merging(s, model._known)


def test_token_counts(docs, none, table):
    path = vocabulary("byte_bpe_50k.json")
    lib = tokenizers.Tokenizer.from_file(path)
    got = token_counts(docs, path, 100)
    matched([tuple(r) for r in got.collect()], table, lambda i, t: (i, len(t.encode()), n := len(lib.encode(t, add_special_tokens=False).ids), n > 100))
    whole = counter(path).whole
    assert len(whole) > 30_000 and all(len(lib.encode(w).ids) == 1 for w in sorted(whole)[::97])
    assert token_counts(none, path).count() == 0


# --- 2 -------------------------------------------------------------------------------------------


def test_media(spark, docs, none, table):
    rows = media.store_and_read(docs, fresh_dir(spark, "media")).collect()
    assert not [r for r in rows if r["error"]]

    def expect(i, t):
        raw = t.encode()
        return (None if i is None else str(i), len(raw), media.pad(raw))

    matched([(r["key"], r["n_bytes"], bytes(r["payload"])) for r in rows], table, expect)
    assert media.store_and_read(none, fresh_dir(spark, "media")).count() == 0


def test_media_damage(spark, docs):
    uri = fresh_dir(spark, "media")
    n = media.write_media(docs.coalesce(1), uri).agg(F.sum("members")).first()[0]
    fs, root = media.open_fs(uri)
    path = next(x.path for x in fs.get_file_info(media.pafs.FileSelector(root)) if x.base_name.endswith(".zip"))
    with open(path, "r+b") as f:
        size = f.seek(0, 2)
        with fs.open_input_file(path) as source:
            places = [m[1:3] for m in media.members(source, size, 0, size)]
        at, length = places[3]
        f.seek(at + length)
        f.write(b"\xff\xff")
    rows = media.media_features(media.read_media(spark, uri, splitBytes=2000, retries=1)).collect()
    assert len(rows) == n == len(places)
    assert [bool(r["error"]) for r in rows].count(True) == 1


def test_media_retry(tmp_path):
    writer = media.ArchiveWriter(f"file://{tmp_path}", "part-0.zip")
    writer.add(b"0/1.png", media.encode_png(b"payload"))
    path, _, _ = writer.close()
    reader = media.MediaArchiveReader({"path": f"file://{tmp_path}", "retries": "2"})
    part = reader.partitions()[0]
    fs, _ = media.open_fs(f"file://{tmp_path}")
    with fs.open_input_file(path) as good:
        name, offset, size, crc = next(media.members(good, part.size, 0, part.size))

    class Broken:
        def seek(self, n):
            raise OSError("lost")

    data, error = reader.fetch(fs, Broken(), path, name, offset, size, crc)
    assert error is None and media.decode_png(data) == (media.pad(b"payload"), 7)


# --- 3 -------------------------------------------------------------------------------------------


def brute_fingerprint(t: str, k: int = 3) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(ids, linked) -> dict:
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_simhash(docs, none, table):
    rows = simhash.near_duplicates(docs).collect()
    fp = [(i, brute_fingerprint(t)) for i, t in table]
    known = [(i, f) for i, f in fp if i is not None]
    part = components([i for i, _ in known], [(a, b) for a, x in known for b, y in known if (x ^ y).bit_count() <= 2])
    assert Counter((r["doc_id"], r["fp"] & (1 << 64) - 1) for r in rows) == Counter(fp)
    for r in rows:
        if r["doc_id"] is not None:
            assert r["component_id"] == part[r["doc_id"]]
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("hot_key", [4096, 3])
def test_gray_links(spark, hot_key):
    """Dense fingerprints; with a small bound every key is refined."""
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    one = np.uint64(1)
    near = [base]
    for _ in range(6):
        near.append(near[-1] ^ (one << r.integers(0, 64, 40).astype(np.uint64)) ^ (one << r.integers(0, 64, 40).astype(np.uint64)))
    low = r.integers(0, 1 << 14, 400, dtype=np.uint64)
    values = np.unique(np.concatenate([*near, low]))
    signed = values.view(np.int64)
    edges = simhash.link_edges(spark.createDataFrame([(int(x),) for x in signed], "fp bigint"), 2, hot_key)
    pairs = [(int(signed[i]), int(signed[j])) for i, j in zip(*np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2), strict=True)]
    want = components(signed.tolist(), pairs)
    got = {r["vertex"]: r["component"] for r in connected_components(edges).collect()}
    assert {k: v for k, v in want.items() if Counter(want.values())[v] > 1} == got


def test_gray_search_prunes():
    r = np.random.default_rng(1)
    index = simhash.GrayIndex(np.unique(r.integers(0, 1 << 63, 5000, dtype=np.uint64)))
    hits = [(int(w), int(a)) for who, at in index.search(index.values[:50], 2) for w, a in zip(who, at, strict=True)]
    assert sorted(hits) == [(i, i) for i in range(50)]
    assert len(index.levels) > 4 and all(bin(int(index.levels[-1][0][0])).count("1") <= 64 for _ in [0])


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (7, 7)]
    for one_task in (0, 1000):
        got = {r["vertex"]: r["component"] for r in connected_components(spark.createDataFrame([*chain, (None, 5)], "a bigint, b bigint"), one_task=one_task).collect()}
        assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}
    r = random.Random(5)
    many = [(r.randrange(900), r.randrange(900)) for _ in range(500)]
    both = [{x["vertex"]: x["component"] for x in connected_components(spark.createDataFrame(many, "a bigint, b bigint"), one_task=n).collect()} for n in (0, 1000)]
    want = components(range(900), many)
    assert both[0] == both[1] == {k: want[k] for k in both[0]} and set(both[0]) == {x for a, b in many if a != b for x in (a, b)}


def test_near_copies(spark, docs, none):
    r = random.Random(9)
    texts: list = []
    for _ in range(60):
        words = prose(r, 150).split()
        texts.append(" ".join(words))
        for n in (1, 2, 3, 12):
            w = list(words)
            for _ in range(n):
                w[r.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    texts += [texts[0], "", None, "  ", "short", "short"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [set(simhash.hashes(t or "", 5).tolist()) for t in texts]
    alike = [(a, b) for a in range(len(texts)) for b in range(a) if (not sets[a] and not sets[b]) or (u := len(sets[a] | sets[b])) and len(sets[a] & sets[b]) >= 0.8 * u]
    want = components(range(len(texts)), alike)
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copy_groups(df).collect()}
    assert got == want
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copy_groups(df, hot_slot=2).collect()}
    assert got == want
    assert near_copies.near_copy_groups(docs).count() == docs.count()
    assert near_copies.near_copy_groups(none).count() == 0


def test_near_copies_large_group():
    """Of many near copies under one slot value candidates stay linear, and nearly all meet a leader."""
    r = np.random.default_rng(2)
    fp = np.full(3000, 0x0123456789ABCDEF, np.uint64) ^ (np.uint64(1) << r.integers(0, 64, 3000).astype(np.uint64))
    i, j = near_copies._pairs_of(fp)
    assert len(i) <= 5 * 3000 and len(np.unique(np.concatenate((i, j)))) == 3000


def grouped_like_brute_force(spark, texts, **more):
    sets = [set(simhash.hashes(t, 5).tolist()) for t in texts]
    holders: dict[int, list[int]] = {}
    for i, x in enumerate(sets):
        for s in x:
            holders.setdefault(s, []).append(i)
    alike = []
    for a, x in enumerate(sets):
        shared = Counter(b for s in x for b in holders[s] if b < a)
        alike += [(a, b) for b, n in shared.items() if n >= 0.8 * (len(x) + len(sets[b]) - n)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copy_groups(df, **more).collect()}
    assert got == components(range(len(texts)), alike)
    return got


def test_near_copies_of_a_hub(spark):
    """2,000 edited copies, each about 0.8 like one original and less like each other, end in its group."""
    r = random.Random(3)
    words = prose(r, 150).split()
    texts = [" ".join(words)]
    for k in range(2000):
        w = list(words)
        for at in sorted(r.sample(range(5, 145), 3)):
            w[at] = f"edit{k}x{at}"
        texts.append(" ".join(w))
    got = grouped_like_brute_force(spark, texts)
    assert list(got.values()).count(0) > 1900


def test_near_copies_short_and_hot(spark):
    """Texts of 4 and 5 shingles, and groups that are cut into small blocks, are grouped as by brute force."""
    r = random.Random(11)
    texts = []
    for k in range(400):
        words = [f"w{k}x{i}" for i in range(9)]
        texts += [" ".join(words), " ".join(words[:8])]
    for k in range(4):
        words = prose(r, 150).split()
        for _ in range(90):
            w = list(words)
            for at in r.sample(range(150), r.randint(1, 4)):
                w[at] = f"edit{r.random()}"
            texts.append(" ".join(w))
    grouped_like_brute_force(spark, texts, hot_slot=7)


def test_near_copies_with_a_repeated_line(spark):
    """A line once or 60 times: nearly the same shingle sets, though the fingerprints are far apart."""
    r = random.Random(12)
    texts = []
    for _ in range(80):
        words, line = prose(r, 200), prose(r, 12)
        texts += [f"{words} {line}", words + f" {line}" * 60]
    got = grouped_like_brute_force(spark, texts)
    assert len(set(got.values())) == 80


# --- 4 -------------------------------------------------------------------------------------------


def test_shards(spark, docs, none, table):
    rows = sharding.shard(docs, 5).collect()
    matched([(r["doc_id"], r["size"], r["text_crc32"]) for r in rows], table, lambda i, t: (i, len(t.encode()) + 8, zlib.crc32(t.encode())))
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert sharding.shard(none, 5).count() == 0
    r = random.Random(4)
    many = [(i, "copy of one text" if i % 3 == 0 else prose(r, r.randint(1, 60)), "hot" if i % 2 else f"s{i % 9}") for i in range(6000)]
    out = sharding.shard(spark.createDataFrame(many, "doc_id bigint, text string, source string"), 24).groupBy("shard").agg(F.sum("size").alias("w")).collect()
    weights = [x["w"] for x in out]
    assert len(weights) == 24 and max(weights) < 1.05 * sum(weights) / 24 and min(weights) > 0.95 * sum(weights) / 24
    pairs = [(i, f"text {i % 2000}", f"s{i % 7}") for i in range(6000)]
    pairs += [(None, "text 1", None)]
    spread = sharding.shard(spark.createDataFrame(pairs, "doc_id bigint, text string, source string"), 24).groupBy("text_crc32").agg(F.countDistinct("shard").alias("n"))
    assert spread.agg(F.max("n")).first()[0] == 1  # equal texts share a shard
    target = sharding.shard(docs, target_bytes=4000).agg(F.max("shard")).first()[0]
    assert target + 1 == -(-sum(len(t.encode()) + 8 for _, t in table) // 4000)


# --- 5 -------------------------------------------------------------------------------------------


def brute_cut(texts: list[bytes], length: int) -> list[tuple[int, int, bytes]]:
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[: len(t)]
        out.append((int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("length,hot", [(40, 2048), (40, 1), (400, 2048), (7, 2048)])
def test_suffix_dedup(docs, none, table, length, hot):
    rows = suffix_dedup.remove_repeats(docs, length, hot_contexts=hot).collect()
    texts = [t.encode() for _, t in table]
    want = [(i, len(b), *w) for (i, _), b, w in zip(table, texts, brute_cut(texts, length), strict=True)]
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in rows) == Counter(want)
    assert all(sum(s["to"] - s["from"] for s in r["spans"]) == r["n_removed"] for r in rows)
    if hot == 1:
        assert suffix_dedup.remove_repeats(none, length).count() == 0


def test_interval_extension():
    r = random.Random(8)
    for _ in range(150):
        length = r.choice([1, 2, 3, 5, 8, 13])
        letters = r.choice([b"a", b"ab", b"abc", bytes(range(0, 255, 5))])
        parts = [bytes(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(r.randint(1, 8))] + [b"ab" * 9]
        count = Counter(p[i : i + length] for p in parts for i in range(len(p) - length + 1))
        want = [[i for i in range(len(p) - length + 1) if count[p[i : i + length]] > 1] for p in parts]
        assert [x.tolist() for x in suffix_dedup.repeated_starts(parts, length)] == want


def test_kept_texts(spark):
    cut = spark.createDataFrame([(1, bytearray("aé".encode()[:-1])), (2, None)], "doc_id bigint, kept binary")
    assert sorted((r["doc_id"], r["kept_text"]) for r in suffix_dedup.kept_texts(cut).collect()) == [(1, "a"), (2, "")]


# --- 7 -------------------------------------------------------------------------------------------


def test_rake_and_mix(spark, docs, none):
    r = np.random.default_rng(5)
    w = r.random(24) + 0.1
    codes = [np.repeat(np.arange(4), 6), np.tile(np.repeat(np.arange(3), 2), 4), np.tile(np.arange(2), 12)]
    goals = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.3, 0.2]), np.array([0.7, 0.3])]
    raked = mixing.rake(w, codes, goals)
    for c, g in zip(codes, goals, strict=True):
        assert np.allclose(np.bincount(c, weights=raked) / w.sum(), g, atol=1e-6)
    p = mixing.probabilities(w, raked, 0.6)
    assert 0 <= p.min() and p.max() <= 1 and np.isclose((p * w).sum(), 0.6 * w.sum())
    rows = mixing.mix(docs, 0.5).collect()
    assert len(rows) == docs.count() and all(0 <= x["probability"] <= 1 for x in rows)
    assert mixing.mix(none).count() == 0
    many = spark.range(20_000).selectExpr("id as doc_id", "'a b c d' as text", "case when id % 3 = 0 then 'hot' else concat('s', id % 7) end as source", "'en' as lang")
    target = {"source": {"hot": 0.2, **{f"s{i}": 0.8 / 7 for i in range(7)}}}
    got = mixing.mix(many, 0.5, target).where("kept").groupBy((F.col("source") == "hot").alias("h")).agg(F.sum("tokens").alias("t")).collect()
    share = {x["h"]: x["t"] for x in got}
    assert abs(share[True] / (share[True] + share[False]) - 0.2) < 0.02 and abs(sum(share.values()) / 80_000 - 0.5) < 0.02


# --- 8 -------------------------------------------------------------------------------------------


def test_chat(spark, sf_dir):
    import duckdb

    hard = ["<|im_end|>", "<\\|x|>", "<\\\\|", "a<", "|b", "", None, "\n", "é😀"]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(zip(["system", "user", "assistant", "user", "assistant", "tool", None, "we\\ird\nrole", "assistant"], hard, strict=True))]
    rows += [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (3, 0, "assistant", "first"), (None, None, "user", "x"), (4, 1, "user", "b"), (4, 1, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    chats = chat.format_chats(df)
    valid = {r["conv_id"]: r["valid"] for r in chats.collect()}
    assert valid == {1: False, 2: True, 3: False, None: False, 4: False}
    turns = {r["conv_id"]: [(t["role"], t["text"]) for t in r["t"]] for r in chats.select("conv_id", chat.parse(F.col("formatted")).alias("t")).collect()}
    assert turns[1] == [(r or "", t or "") for _, _, r, t in rows[:9]] and turns[4] == [("user", "a"), ("user", "b")]
    assert chat.format_chats(df.limit(0)).count() == 0
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    want = {tuple(map(str, r)) for r in con.sql(ORACLE_SQL["op8_chat"]).fetchall()}
    assert {tuple(map(str, r)) for r in QUERIES["op8_chat"](spark, sf_dir).collect()} == want


# --- 9 -------------------------------------------------------------------------------------------


def brute_minima(h: list[int], w: int) -> list[int]:
    w = min(w, len(h))
    return [max(range(i, i + w), key=lambda j: (-h[j], j)) for i in range(len(h) - w + 1)]


def test_minima():
    r = random.Random(6)
    for bits in (20, 3):
        for _ in range(60):
            h = [r.randint(0, 4) for _ in range(r.randint(1, 60))]
            w = r.randint(1, 20)
            with pytest.MonkeyPatch.context() as m:
                m.setattr("foliary.llm.windows.POSITION_BITS", bits)
                assert rightmost_minima(np.array(h, np.uint64) << np.uint64(50), w).tolist() == brute_minima(h, w)


def test_winnowing(spark, docs, none, table):
    k, w = winnowing.K, winnowing.W
    text = prose(random.Random(2), 400)
    piece = text[500 : 500 + k + w - 1]
    assert set(winnowing.winnow("zz " * 20 + piece + " yy" * 20).hashes.tolist()) & set(winnowing.winnow(text).hashes.tolist())
    rows = winnowing.with_successor(docs).collect()
    signed = lambda t: xxhash.xxh64_intdigest(t, 42) - (1 << 64) * (xxhash.xxh64_intdigest(t, 42) >> 63)
    order = sorted(table, key=lambda x: (x[0] is not None, x[0] or 0, signed(x[1])))
    want = []
    for n, (i, t) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        own, edited, nxt = (winnowing.winnow(x) for x in (t, winnowing.edit(t, after), after))
        a, b, c = (set(f.hashes.tolist()) for f in (own, edited, nxt))
        like = lambda p, q: len(p & q) / len(p | q) if p | q else 1.0
        want.append((i, len(t), sha(winnowing.edit(t, after)), own.digest(), edited.digest(), round(like(a, b), 12), round(like(a, c), 12)))
    assert Counter((*r[:5], round(r[5], 12), round(r[6], 12)) for r in rows) == Counter(want)
    assert winnowing.with_successor(none).count() == 0
    alone = winnowing.with_successor(spark.createDataFrame([(1, "abcd")], "doc_id bigint, text string")).collect()
    assert alone[0]["edited_sha256"] == sha("abab") and alone[0]["near_next"] == 1.0
    assert winnowing.winnow_fingerprints(docs).count() == docs.count()


# --- 10 ------------------------------------------------------------------------------------------


def test_trees():
    r = np.random.default_rng(0)
    x = r.random((2000, 4))
    y = ((x[:, 0] > 0.6) & (x[:, 2] < 0.5)).astype(float)
    raw = BoostedTrees(trees=40).fit(x, y).raw(x)
    assert ((raw > 0) == (y > 0)).mean() > 0.99
    knots, level = isotonic(raw, y)
    assert (np.diff(knots) >= 0).all() and (np.diff(level) >= 0).all()


def test_toxicity(spark, docs, none, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.1")
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.score(d, toxicity.train(d, labels, 4000)).join(labels, "doc_id").where("held_out").collect()
    y, p, s = (np.array([r[c] for r in rows]) for c in ("toxic", "predicted", "score"))
    assert p[y == 1].mean() > 0.85 and p[y == 0].mean() < 0.05
    assert np.mean([(a > s[y == 0]).mean() + (a == s[y == 0]).mean() / 2 for a in s[y == 1]]) > 0.97
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["held_out"] for r in rows)
    blank = toxicity.train(none, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert {r["score"] for r in toxicity.score(docs, blank).collect()} == {0.0}
    assert toxicity.score(none, blank).count() == 0
