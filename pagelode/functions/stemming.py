"""English stems as a column.

Word counts follow a steep power law, so each Python worker sees few new words per Arrow batch:
a batch is reduced to its distinct words and those are looked up in a bounded memo. That costs
no shuffle, unlike a join with a vocabulary table, whose frequent words would be skewed keys, and
it measured several times faster than a chain of regular-expression columns.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions import porter2

# Workers need not have the package installed: ship the helper with the function.
cloudpickle.register_pickle_by_value(porter2)

MEMO_LIMIT = 500_000


def _stemmer():
    memo: dict[str, str] = {}
    limit = MEMO_LIMIT
    stem_word = porter2.stem

    def stem_values(words):
        codes, distinct = pd.factorize(words)
        if len(memo) > limit:
            memo.clear()
        # One slot more than there are words: NULL has code -1 and finds None there.
        stems = np.empty(len(distinct) + 1, dtype=object)
        for i, word in enumerate(distinct):
            stem = memo.get(word)
            if stem is None:
                stem = memo[word] = stem_word(word)
            stems[i] = stem
        return stems[codes]

    return stem_values


def stem(word: Column) -> Column:
    """Stem of a lower-case word; NULL for NULL."""
    stem_values = _stemmer()

    def stem_batch(words: pd.Series) -> pd.Series:
        return pd.Series(stem_values(words))

    return F.pandas_udf(stem_batch, "string")(word)


def stem_all(words: Column) -> Column:
    """Stems of an array of lower-case words, in order; NULL for NULL."""
    stem_values = _stemmer()

    def stem_batch(lists: pd.Series) -> pd.Series:
        missing = lists.isna()
        if missing.any():
            present = stem_batch(lists[~missing].reset_index(drop=True))
            out = np.full(len(lists), None, dtype=object)
            out[np.flatnonzero(~missing)] = present.to_numpy()
            return pd.Series(out)
        arrays = list(lists)
        if not arrays:
            return pd.Series([], dtype=object)
        stems = stem_values(np.concatenate(arrays)) if any(map(len, arrays)) else np.empty(0, dtype=object)
        ends = np.cumsum([len(a) for a in arrays])
        return pd.Series(np.split(stems, ends[:-1]))

    return F.pandas_udf(stem_batch, "array<string>")(words)


def with_stem(df: DataFrame, word: str, out: str) -> DataFrame:
    return df.withColumn(out, stem(F.col(word)))
