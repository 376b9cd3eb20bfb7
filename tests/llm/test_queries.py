"""The registered queries of the training-data operators against versions written from the contract alone."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from foliary.llm import mixing, toxicity
from foliary.llm.queries import QUERIES, vocabulary

CONTRACT = {
    "op1_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op2_media": {"doc_id": "bigint", "n_bytes": "bigint", "payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint", "media_sha256": "string", "feature": "string"},
    "op3_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op4_shards": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op5_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op6_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op7_mix": {"doc_id": "bigint", "source": "string", "lang": "string", "topic": "string", "tokens": "bigint", "probability": "double", "kept": "boolean"},
    "op8_chat": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint", "valid": "boolean"},
    "op9_winnowing": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op10_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
}


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    """What each query returns, once."""
    made = {}

    def get(name):
        if name not in made:
            df = QUERIES[name](spark, sf_dir)
            types = dict(df.dtypes)
            assert {c: types.get(c) for c in CONTRACT[name]} == CONTRACT[name]
            made[name] = df.collect()
        return made[name]

    return get


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def same(got, want: dict, *columns):
    assert {r["doc_id"]: tuple(r[c] for c in columns) for r in got} == want
    assert len(got) == len(want)


def library(name):
    return pytest.importorskip("tokenizers").Tokenizer.from_file(vocabulary(name))


def test_op1(rows, docs):
    lib, want = library("word_bpe_49k.json"), {}
    for i, t in docs.items():
        ids = lib.encode(t, add_special_tokens=False).ids
        want[i] = len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(lib.decode(ids, skip_special_tokens=False))
    same(rows("op1_bpe"), want, "n_tokens", "ids_sha256", "decoded_sha256")


def test_op2(rows, docs):
    want = {}
    for i, t in docs.items():
        raw = t.encode()
        pay = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        lines = [pay[k : k + 192] for k in range(0, len(pay), 192)]
        chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
        png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">2I5B", 192, len(lines), 8, 0, 0, 0, 0)) + chunk(b"plEn", struct.pack(">Q", len(raw))) + chunk(b"IDAT", zlib.compress(b"".join(b"\0" + x for x in lines), 1)) + chunk(b"IEND", b"")
        mean = sum(pay) / len(pay)
        deviation = math.sqrt(sum((x - mean) ** 2 for x in pay) / len(pay))
        entropy = -sum(n / len(pay) * math.log2(n / len(pay)) for n in Counter(pay).values())
        edge = sum(abs(a - b) for x in lines for a, b in zip(x, x[1:])) / len(pay)
        want[i] = len(raw), len(pay), sha(pay), zlib.crc32(pay[-16:]), len(png), sha(png), (192, len(lines), mean, deviation, entropy, edge)
    got = rows("op2_media")
    assert len(got) == len(want)
    for r in got:
        *exact, told = want[r["doc_id"]]
        assert [r[c] for c in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256")] == exact
        assert [float(x) for x in re.findall(r"[\d.]+", r["feature"])] == pytest.approx(told, abs=1e-4)


def test_op3(rows, docs):
    def fingerprint(t):
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        grams = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = {i: fingerprint(t) for i, t in docs.items()}
    group = {i: i for i in fp}
    for _ in fp:
        before = dict(group)
        for a in fp:
            group[a] = min(group[b] for b in fp if (fp[a] ^ fp[b]).bit_count() <= 2)
        if group == before:
            break
    same(rows("op3_simhash"), {i: (f"{fp[i]:016x}", group[i]) for i in fp}, "fingerprint", "component_id")


def test_op4(rows, docs):
    got = rows("op4_shards")
    same(got, {i: (len(t.encode()) + 8, zlib.crc32(t.encode()), "bytes", None) for i, t in docs.items()}, "size", "text_crc32", "law", "grown_shard")
    held = defaultdict(list)
    for r in got:
        held[r["shard"]].append(r)
    assert set(held) <= set(range(24))
    weights = [sum(r["size"] for r in x) for x in held.values()]
    most = max(r["size"] for r in got)
    assert max(weights) - min(weights) <= 2 * most  # a cut is off by half a text at most, at each of five levels
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in held.values())


def test_op5(rows, docs):
    raw = {i: t.encode() for i, t in docs.items()}
    starts = Counter(b[k : k + 400] for b in raw.values() for k in range(len(b) - 399))
    want = {}
    for i, b in raw.items():
        gone = np.zeros(len(b) + 2, int)
        for k in range(len(b) - 399):
            if starts[b[k : k + 400]] > 1:
                gone[k + 1 : k + 401] = 1
        kept = bytes(np.frombuffer(b, np.uint8)[gone[1:-1] == 0])
        want[i] = len(b), int(gone.sum()), int((np.diff(gone) == 1).sum()), sha(kept), kept.decode("utf-8", "replace")
    same(rows("op5_suffix_dedup"), {i: w[:4] for i, w in want.items()}, "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert all(r["text"] == want[r["doc_id"]][4] for r in rows("op5_suffix_dedup"))


def test_op6(rows, docs):
    lib = library("byte_bpe_50k.json")
    n = {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in docs.items()}
    same(rows("op6_token_counts"), {i: (len(docs[i].encode()), k, k > 1024) for i, k in n.items()}, "n_bytes", "n_tokens", "over_limit")


def test_op7(rows, docs):
    got = rows("op7_mix")
    assert {r["doc_id"] for r in got} == set(docs) and len(got) == len(docs)
    cells = Counter()
    for r in got:
        cells[r["source"], r["lang"], r["topic"]] += r["tokens"]
    total = sum(cells.values())
    fitted = {c: float(w) for c, w in cells.items()}
    goals = []
    for axis in range(3):
        seen = Counter()
        for c, w in cells.items():
            seen[c[axis]] += w
        raised = {k: w**0.7 for k, w in seen.items() if w}
        goals.append({k: v / sum(raised.values()) * total for k, v in raised.items()})
    for _ in range(600):
        for axis, goal in enumerate(goals):
            now = Counter()
            for c, w in fitted.items():
                now[c[axis]] += w
            fitted = {c: w * goal.get(c[axis], 0) / now[c[axis]] if now[c[axis]] else w for c, w in fitted.items()}
    low, high = 0.0, 1e9
    for _ in range(200):  # the factor whose capped probabilities keep 0.8 of the tokens
        c = (low + high) / 2
        kept = sum(w * min(1, c * fitted[k] / w) for k, w in cells.items() if w)
        low, high = (c, high) if kept < 0.8 * total else (low, c)
    for r in got:
        k = r["source"], r["lang"], r["topic"]
        assert r["probability"] == pytest.approx(min(1, low * fitted[k] / cells[k]) if cells[k] else 0.8, rel=1e-4, abs=1e-6)
    drawn = {r["doc_id"]: (r["kept"], r["probability"]) for r in got}
    assert all(k for k, p in drawn.values() if p >= 1)
    assert abs(sum(k for k, _ in drawn.values()) - sum(p for _, p in drawn.values())) < 5 * math.sqrt(sum(p * (1 - p) for _, p in drawn.values()) + 1)


@pytest.mark.parametrize("targets", [None, {"source": {"hot": 0.5, "s1": 0.2}, "lang": {"en": 1.0}}])
def test_op7_as_a_table(spark, targets):
    """The fit over a distributed table of cells gives what the arrays give, with more categories than any list holds."""
    many = spark.range(6000).selectExpr("nullif(id, 17) as doc_id", "repeat('a b ', cast(id % 13 as int)) as text", "case when id % 3 = 0 then 'hot' else concat('s', id % 1500) end as source", "case when id % 7 < 5 then 'en' else 'de' end as lang", "'x' as topic")
    a, b = ({(r["doc_id"], r["source"]): r["probability"] for r in mixing.mix(many, 0.5, targets, most_cells=n).collect()} for n in (1_000_000, 0))
    assert a.keys() == b.keys() and len(a) == 6000
    assert max(abs(a[k] - b[k]) for k in a) < 1e-6
    if not targets:
        assert len({round(p, 9) for p in a.values()}) > 100


def test_op9(rows, docs):
    base, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1

    def chosen(t):
        """Hashes and positions by the definition: a polynomial over code points plus one, mixed; the rightmost least of 16."""
        if len(t) < 16:
            return {(xxhash.xxh3_64_intdigest(t.encode("utf-32-le")), 0)} if t else set()
        h = []
        for k in range(len(t) - 15):
            x = 0
            for c in t[k : k + 16]:
                x = (x * base + ord(c) + 1) & mask
            x ^= x >> 32
            x = x * 0xD6E8FEB86659FD93 & mask
            h.append(x ^ x >> 29)
        w = min(16, len(h))
        return {(h[j], j) for k in range(len(h) - w + 1) for j in [min(range(k, k + w), key=lambda j: (h[j] >> 20, -j))]}

    def digest(found):
        order = sorted(found, key=lambda x: x[1])
        return xxhash.xxh3_128_hexdigest(struct.pack(f"<{len(order)}Q", *[h for h, _ in order]) + struct.pack(f"<{len(order)}q", *[p for _, p in order]))

    def like(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    ids, got = sorted(docs), {r["doc_id"]: r for r in rows("op9_winnowing")}
    assert len(got) == len(ids) == len(rows("op9_winnowing"))
    for n, i in enumerate(ids):
        r, after = got[i], docs[ids[(n + 1) % len(ids)]]
        edited = docs[i][: len(docs[i]) - len(docs[i]) // 2] + after[: len(docs[i]) // 2]
        assert (r["n_chars"], r["edited_sha256"]) == (len(docs[i]), sha(edited))
        if n % 8 == 0:  # slow by the definition
            own, other, nxt = chosen(docs[i]), chosen(edited), chosen(after)
            assert (r["fingerprint"], r["edited_fingerprint"]) == (digest(own), digest(other))
            assert (r["near_edited"], r["near_next"]) == pytest.approx((like(own, other), like(own, nxt)))


def test_op10(rows, docs):
    got = rows("op10_toxicity")
    same(got, {i: (zlib.crc32(str(i).encode()) % 4 == 2,) for i in docs}, "held_out")
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    by_text = defaultdict(set)
    for r in got:
        by_text[docs[r["doc_id"]]].add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())


def test_op10_odd_labels(spark):
    """Null labels and ids, an id with both labels, repeated documents, labels without a document, one kind of label only."""
    r = np.random.default_rng(7)
    word = lambda: f"w{r.integers(0, 500)}"
    texts = [" ".join([word() for _ in range(60)] + (["zonk", "grubby"] * 3 if i % 5 == 0 else [])) for i in range(600)]
    docs = spark.createDataFrame([*enumerate(texts), (1, texts[1]), (1, "another text of the same id"), (None, texts[0]), (700, None)], "doc_id bigint, text string")
    labels = [(i, int(i % 5 == 0)) for i in range(600)] + [(None, 1), (3, None), (4, 1), (9999, 1), (700, 0)]
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(docs, table)
    assert "zonk" in model.stems
    out = toxicity.score(docs, model).collect()
    assert len(out) == 604
    held = [(x["predicted"], x["doc_id"] % 5 == 0) for x in out if x["held_out"] and x["doc_id"] is not None and x["doc_id"] < 600]
    assert np.mean([p == y for p, y in held]) > 0.95
    again = toxicity.score(docs.repartition(7), toxicity.train(docs.repartition(5), table.repartition(3))).collect()
    assert Counter((x["doc_id"], round(x["score"], 9)) for x in again) == Counter((x["doc_id"], round(x["score"], 9)) for x in out)
    ones = toxicity.train(docs, table.where("toxic = 1"))
    assert {x["score"] for x in toxicity.score(docs, ones).collect()} == {1.0}


def test_op8_long_and_clashing(spark):
    """A conversation of thousands of turns with a very long one, and extra columns named like outputs."""
    from foliary.llm import chat

    turns = [(7, i, ("user", "assistant")[i % 2], "<|im_end|>" * 3 if i % 3 else "x" * 20, "clash", True) for i in range(4000)]
    turns[5] = (7, 5, "assistant", "y" * 2_000_000, "clash", True)
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string, formatted string, valid boolean")
    r = chat.digests(chat.format_chats(df)).collect()[0]
    loss = "".join(t for _, _, role, t, _, _ in turns if role == "assistant")
    assert (r["n_turns"], r["valid"], r["loss_chars"], r["loss_sha256"]) == (4000, True, len(loss), sha(loss))
    assert r["turns_sha256"] == sha("".join(f"{role}\n{t}\n" for _, _, role, t, _, _ in turns))
