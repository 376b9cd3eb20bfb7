"""Token counts with a whole-token shortcut.

Offline, before any text is read, every vocabulary string is proved: it is a
pre-token by itself and the merges turn it into exactly one token. A pre-token
of that table counts 1 with one look-up; only the others are merged.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliary.llm.bpe import BpeModel, WordCache, load
from foliary.llm.common import hold, map_texts, texts_of


class TokenCounter:
    def __init__(self, model: BpeModel):
        self.model = model
        self.whole = self.prove(model)
        self.counts = WordCache(lambda w: 1 if w in self.whole else len(model.encode_symbols(model.word_symbols(w))))

    @staticmethod
    def prove(model: BpeModel) -> frozenset[str]:
        """The pre-tokens that are one token: their symbols are a proved token, and the split pattern leaves them whole.

        Vocabulary strings that are no UTF-8 text, that the pattern would cut,
        or that are a special token's text never come up as one pre-token.
        """
        out = set()
        for token, proved in zip(model.merges.tokens, model.proved, strict=True):
            raw = [ord(c) for c in token]
            if model.suffix:
                if raw[-1] < 256 or max(raw[:-1], default=0) > 255:
                    continue
                raw[-1] -= 256
            try:
                word = bytes(raw).decode("utf-8")
            except UnicodeDecodeError:
                continue
            if proved and word not in model.special and model.split(word) == [word]:
                out.add(word)
        return frozenset(out)

    def count(self, text: str) -> int:
        total, model = 0, self.model
        for part, special in model.segments(text):
            total += 1 if special is not None else sum(map(self.counts.__getitem__, model.split(model.normalize(part))))
        return total


@lru_cache(maxsize=1)
def counter(path: str) -> TokenCounter:
    return TokenCounter(load(path))


def release() -> None:
    counter.cache_clear()
    load.cache_clear()


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count tokens of whole texts: (id, n_bytes, n_tokens, over_limit).

    A null or empty text has 0 bytes and 0 tokens. One row per input row, no
    shuffle; memory is a batch slice, the proved table and the pre-token cache.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold("token counts", release)
        counts, texts = counter(path), texts_of(batch, text_col)
        n = [counts.count(t) for t in texts]
        size = [len(t) if t.isascii() else len(t.encode()) for t in texts]
        return pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col, text_col], text_col, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean", work)


def with_token_counts(docs: DataFrame, path: str, text_col: str = "text", name: str = "n_tokens") -> DataFrame:
    """``docs`` with a column of token counts, row by row; a column of that name is replaced."""
    kept = docs.drop(name)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.LongType())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hold("token counts", release)
        counts = counter(path)
        return batch.append_column(name, pa.array([counts.count(t) for t in texts_of(batch, text_col)], pa.int64()))

    return map_texts(kept, [F.col(f"`{c}`") for c in kept.columns], text_col, schema, work)
