"""Token counts of whole texts without materialising ids.

A text's pre-tokens are counted, each distinct pre-token's pieces are counted once,
and the two are joined and summed.  The pieces of a pre-token do not depend on its
text, so the join needs no shuffle: every task keeps a bounded table pre-token ->
pieces and extends it by the pre-tokens of the batch that it lacks.  A joined table
of all pre-tokens was not used: one row per document and distinct pre-token is more
than the texts themselves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import CACHED_LENGTH, load_tokenizer

# Fixed value: the split of byte-level vocabularies before merges.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Pre-tokens in each of the two generations that a worker keeps.
KEPT = 300_000
# Only of these characters are the classes the same in every Unicode version and library.
_PLAIN = regex.compile(r"[\t\n\r -~¡-¬®-ɏ]*")


class PieceCounts:
    """Pre-token -> its number of pieces, for a byte-level tokenizer."""

    def __init__(self, tokenizer):
        self.split = regex.compile(PRE_TOKEN).findall
        self.pre_tokenize = tokenizer.pre_tokenizer.pre_tokenize_str
        self.encode = tokenizer.encode
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return self.split(text)
        return [text[a:b] for _, (a, b) in self.pre_tokenize(text)]

    def pieces(self, token: str) -> int:
        n = self.young.get(token)
        if n is None:
            n = self.old.get(token)
            if n is None:
                n = len(self.encode(token, add_special_tokens=False))
            if len(token) <= CACHED_LENGTH:
                if len(self.young) >= KEPT:
                    self.old, self.young = self.young, {}
                self.young[token] = n
        return n

    def text(self, text: str | None) -> int:
        """Special strings count one each, as the library takes them, and split the text."""
        if not text:
            return 0
        specials = 0
        parts = [text]
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            specials = len(parts) - 1
        frequencies = Counter()
        for part in parts:
            frequencies.update(self.pre_tokens(part))
        pieces = self.pieces
        return specials + sum([n * pieces(token) for token, n in frequencies.items()])


_COUNTS: dict[str, PieceCounts] = {}


def _counts(name: str) -> PieceCounts:
    if name not in _COUNTS:
        _COUNTS[name] = PieceCounts(load_tokenizer(name))
    return _COUNTS[name]


def n_tokens(text: Column | str, tokenizer: str) -> Column:
    """Tokens of each whole text; NULL and empty texts have none."""

    @pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = _counts(tokenizer)
        for texts in batches:
            yield pd.Series([counts.text(t) for t in texts], dtype="int64")

    return count(text)


def token_counts(docs: DataFrame, tokenizer: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every row.

    Only the id and text columns are read.  NULL and empty texts have 0 bytes and
    tokens; repeated rows stay repeated; an empty table gives an empty result.
    """
    text = F.col(text_col).cast("string")
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        n_tokens(text, tokenizer).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
