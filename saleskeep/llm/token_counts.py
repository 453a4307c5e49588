"""Token counts by dynamic programming over a trie of pre-tokens.

The distinct pre-tokens of a part of the corpus form a trie. Walking it in sorted order visits
its nodes depth first: the scores of a prefix that two words share are computed once and kept
on the path, and the node where a word ends yields its score and token count. A task keeps the
counts of words it has met (at most MEMO_WORDS, then it starts afresh), so only new words enter
the trie. Nothing is shuffled.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleskeep.llm import vocabulary as voc
from saleskeep.llm.common import SLICE_BYTES, map_texts

#: Words a task remembers.
MEMO_WORDS = 600_000


def count_tokens(documents: DataFrame, path: str = voc.PIECES, id_column: str = "doc_id") -> DataFrame:
    """One row per row of `documents`: its id, n_pretokens, n_tokens. Texts that are NULL or
    empty have none of either; repeated rows are counted each."""
    shared = documents.sparkSession.sparkContext.broadcast(voc.load(path))

    def make():
        vocabulary, memo = shared.value, {}

        def counts(batch: pa.RecordBatch) -> list:
            split = [voc.pre_tokens(text) for text in batch.column("text").to_pylist()]
            if len(memo) > MEMO_WORDS:
                memo.clear()
            new = sorted(set().union(*split).difference(memo))
            for word, (_, ids) in zip(new, voc.segment(new, vocabulary)):
                memo[word] = len(ids) // 4
            totals = [sum(map(memo.__getitem__, words)) for words in split]
            return [batch.column("id"), [len(words) for words in split], totals]

        return counts

    rows = documents.select(F.col(id_column).alias("id"), "text")
    kind = rows.schema["id"].dataType.simpleString()
    return map_texts(rows, make, f"id {kind}, n_pretokens long, n_tokens long", limit=2 * SLICE_BYTES).withColumnRenamed("id", id_column)
