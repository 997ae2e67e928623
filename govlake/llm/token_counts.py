"""Exact token counts by the whole-token shortcut.

Most pre-tokens of ordinary text are one token. Before counting, every string of the vocabulary
is encoded alone; those that come out as themselves are proven whole tokens. A text is cut into
pre-tokens by the tokenizer's own pattern; proven ones count 1 by a table lookup, and only the
rest go through the library's merges, remembered in a bounded table.
"""

from __future__ import annotations

import functools

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from tokenizers import Tokenizer

from . import tokens
from .shared import text_of

# Fixed value: the published pre-token pattern of byte-level BPE.
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Blocks in which this pattern and the tokenizer's agree on every character; they may
# know different Unicode versions elsewhere. A text with any other character is left to the library.
UNSURE = regex.compile(
    r"[^\u0000-\u0557\u0600-\u06ff\u0900-\u097f\u2000-\u206f\u20a0-\u20bf\u2190-\u23ff\u2500-\u27bf"
    r"\u3000-\u30ff\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uff5e\U0001f300-\U0001f64f]")


def prove_whole(tokenizer: Tokenizer) -> list[str]:
    """Vocabulary strings that, alone, are one pre-token and encode to their own id."""
    size = tokenizer.get_vocab_size(with_added_tokens=False)
    strings = [tokenizer.decode([i], skip_special_tokens=False) for i in range(size)]
    coded = tokenizer.encode_batch(strings, add_special_tokens=False)
    return [s for i, (s, c) in enumerate(zip(strings, coded, strict=True))
            if c.ids == [i] and PRE_TOKEN.findall(s) == [s]]


class PreTokenCosts(dict):
    """Pre-token -> number of tokens."""

    def __init__(self, path: str):
        self.tokenizer = tokens.load(path)
        self.merge = self.tokenizer.model.tokenize
        self.whole = prove_whole(self.tokenizer)
        super().__init__(dict.fromkeys(self.whole, 1))
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()),
                       key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None

    def __missing__(self, piece: str) -> int:
        n = len(self.merge(piece.encode().decode("latin-1").translate(tokens.BYTE_LETTERS)))
        if len(piece) <= 64:
            if len(self) >= tokens.REMEMBERED:
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[piece] = n
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not text.isascii() and UNSURE.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self.added is None or not self.added.search(text):
            return sum(map(self.__getitem__, PRE_TOKEN.findall(text)))
        # a special string is one token and cuts the text, as in the library's default
        return (len(self.added.findall(text))
                + sum(self.count(part) for part in self.added.split(text)))


@functools.lru_cache(maxsize=4)
def costs(path: str) -> PreTokenCosts:
    return PreTokenCosts(path)


def token_count(text: Column, path: str) -> Column:
    """Tokens of a byte-level BPE file without begin, end or added tokens; null counts 0."""

    @F.pandas_udf(LongType())
    def counted(texts: pd.Series) -> pd.Series:
        table = costs(path)
        return pd.Series([table.count(t) for t in texts], dtype="int64")

    return counted(text)


def document_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """One row per document: n_bytes, n_tokens, over_limit. Null and empty texts count 0; a
    repeated or null doc_id keeps its rows; other columns are not read."""
    whole = docs.select("doc_id", text_of().alias("text"))
    return (whole.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                         token_count(F.col("text"), path).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
