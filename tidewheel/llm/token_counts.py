"""Token counts by distinct pre-token.

Documents are read in blocks. A block keeps its documents as counts of words, its words as lists of
pre-tokens, and its distinct pre-tokens. The pre-tokens of all blocks are brought together by value,
the tokenizer's model counts the pieces of each distinct one once, and the counts go back to the
blocks that asked, where they are summed per document. No token ids are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import batch_of, chunks, documents, stored_by, text_bytes

#: Bytes of text in a block, and words that a task remembers.
BLOCK_BYTES = 16 << 20
KNOWN_WORDS = 400_000


class PreTokens:
    """The pre-tokens of words, as the tokenizer's own normaliser and splitter give them."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(sorted(special, key=len, reverse=True)) + ")") if special else None
        self.known: dict[bytes, list[str]] = {}

    def of(self, word: bytes) -> list[str]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > KNOWN_WORDS:
                self.known.clear()
            found = self.known[word] = self._split(word.decode("utf8", "replace"))
        return found

    def _split(self, word: str) -> list[str]:
        parts = self.special.split(word) if self.special else [word]
        found = []
        for k, part in enumerate(parts):
            if k % 2:
                found.append(part)
            elif part:
                plain = self.tokenizer.normalizer.normalize_str(part) if self.tokenizer.normalizer else part
                found += [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)]
        return found


_FIELDS = ("word_of", "times", "n_entries", "pre_of", "n_pre")


def _blocks(docs: DataFrame, vocabulary: str) -> DataFrame:
    schema = pa.schema(
        [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_bytes", pa.list_(pa.int64())), ("pre_tokens", pa.list_(pa.string()))]
        + [(f, pa.binary()) for f in _FIELDS]
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, base, number = PreTokens(vocabulary), TaskContext.get().partitionId() << 30, 0
        ids, sizes, words, docs_of, times, size = [], [], {}, [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal number, ids, sizes, words, docs_of, times, size
            index: dict[str, int] = {}
            lists = [pre.of(w) for w in words]
            pre_of = [index.setdefault(p, len(index)) for found in lists for p in found]
            entries = np.array([len(d) for d in docs_of], np.uint32)
            steps = [np.diff(d, prepend=0) for d in docs_of]  # small numbers, which compress well
            binary = {
                "word_of": np.concatenate(steps).astype("<i4").tobytes(),
                "times": np.concatenate(times).astype("<u4").tobytes(),
                "n_entries": entries.tobytes(),
                "pre_of": np.array(pre_of, "<u4").tobytes(),
                "n_pre": np.array([len(x) for x in lists], "<u4").tobytes(),
            }
            out = batch_of(
                schema, block=[base + number], doc_ids=[ids], n_bytes=[sizes], pre_tokens=[list(index)],
                **{k: [v] for k, v in binary.items()},
            )
            number += 1
            ids, sizes, words, docs_of, times, size = [], [], {}, [], [], 0
            return out

        for chunk in chunks(batches):
            data, at = text_bytes(chunk.column("text"))
            raw, add = data.tobytes(), words.setdefault
            for doc_id, a, b in zip(chunk.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                count = Counter(raw[a:b].split())
                number_of = np.array([add(w, len(words)) for w in count], np.int64)
                order = np.argsort(number_of)
                ids.append(doc_id)
                sizes.append(b - a)
                docs_of.append(number_of[order])
                times.append(np.fromiter(count.values(), np.int64, len(count))[order])
            size += len(raw)
            if size >= BLOCK_BYTES:
                yield block()
        if ids:
            yield block()

    text = "block long, doc_ids array<long>, n_bytes array<long>, pre_tokens array<string>, " + ", ".join(f"{f} binary" for f in _FIELDS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(made, text)


def _pieces(wanted: DataFrame, vocabulary: str) -> DataFrame:
    """block, at, n: the number of pieces of each wanted pre-token. Equal ones are brought together and
    counted once."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = PreTokens(vocabulary)
        model, last, n_last = pre.tokenizer.model, None, 0
        for batch in batches:
            coded = pc.dictionary_encode(batch.column("pre_token"))
            values = coded.dictionary.to_pylist()
            n = []
            for v in values:
                if v != last:
                    last = v
                    n_last = 1 if pre.special and pre.special.fullmatch(v) else len(model.tokenize(v))
                n.append(n_last)
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("at"), pa.array(n, pa.int32()).take(coded.indices)], ["block", "at", "n"]
            )

    together = wanted.repartition("pre_token").sortWithinPartitions("pre_token")
    return together.mapInArrow(counted, "block long, at int, n int")


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every document.

    ``docs`` needs doc_id and text; other columns are ignored. A null or empty text has no bytes and
    no tokens. A null doc_id is kept as null; repeated rows come back once each. An empty table gives
    no rows. The counts are those of the tokenizers library for the file ``vocabulary`` without
    special tokens added; strings in a text that look like special tokens are handled as it does by
    default. Words are split at ASCII white space first, which that vocabulary's splitter must drop.
    """
    blocks = stored_by(_blocks(docs, vocabulary), "block", "token_blocks")
    pieces = _pieces(blocks.select("block", F.posexplode("pre_tokens").alias("at", "pre_token")), vocabulary)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def summed(asked: pa.Table, found: pa.Table) -> pa.Table:
        n = np.zeros(found.num_rows, np.int64)
        n[found.column("at").to_numpy()] = found.column("n").to_numpy()
        out = []
        for row in asked.to_pylist():
            get = lambda f, kind: np.frombuffer(row[f], kind).astype(np.int64)  # noqa: B023, E731
            n_pre, entries = get("n_pre", "<u4"), get("n_entries", "<u4")
            of_word = np.bincount(np.repeat(np.arange(len(n_pre)), n_pre), n[get("pre_of", "<u4")], len(n_pre))
            doc = np.repeat(np.arange(len(entries)), entries)
            steps = get("word_of", "<i4")
            word = np.cumsum(steps)
            first = np.cumsum(entries) - entries
            begin = np.where(entries > 0, np.concatenate([[0], word])[first], 0)  # the sum before each document
            word -= np.repeat(begin, entries)
            sums = np.bincount(doc, of_word[word] * get("times", "<u4"), len(entries))
            out.append(pa.table([pa.array(row["doc_ids"], pa.int64()), pa.array(row["n_bytes"], pa.int64()), pa.array(sums.astype(np.int64))], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return (
        blocks.drop("pre_tokens")
        .groupBy("block")
        .cogroup(pieces.groupBy("block"))
        .applyInArrow(summed, "doc_id long, n_bytes long, n_tokens long")
    )


def op5_pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)
