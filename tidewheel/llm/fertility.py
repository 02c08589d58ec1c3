"""Quality rules from tokeniser fertility.

A public sentencepiece vocabulary with byte fallback measures three figures of every document: the
characters per token, the share of byte-fallback tokens, and the entropy of its tokens relative to
the most that many tokens can have. Each language (or script, where the language is unknown) has a
band per figure: median plus and minus a multiple of the median absolute deviation over all its
documents of that language and length class (entropy falls with length). Classes of few documents are judged
by the whole language or script. Documents outside a band are rejected, besides those that fail plain base rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import batch_of, bounded, chunks, documents, gathered, mixed, stored, text_bytes

#: Words that a task remembers.
KNOWN_WORDS = 400_000
#: Length of the word windows that count as repeats.
WINDOW = 8
FIGURES = ("chars_per_token", "byte_share", "entropy_ratio")
#: The least half width of a band: as a share of the median, or absolute.
LEAST_WIDTH = {"chars_per_token": 0.5, "byte_share": 0.25, "entropy_ratio": 0.05, "token_entropy": 0.5}
#: Length classes to a doubling of the token count.
CLASSES = 2
#: Documents behind a band, at least; a class with fewer takes a wider band.
LEAST_DOCUMENTS = 20
#: Figures with a band; the entropy itself counts where documents of other lengths are behind the band.
BANDED = (*FIGURES, "token_entropy")
#: Bands that are broadcast at most.
BANDS = 50_000

# First bytes of UTF-8 characters by script, as blocks of Unicode have them (fixed values).
SCRIPTS = ("latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "cjk", "hangul")
_SCRIPT_OF = np.full(256, len(SCRIPTS), np.int64)
for _k, _bytes in enumerate(
    ([*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)], [0xCE, 0xCF], range(0xD0, 0xD4), [0xD7],
     range(0xD8, 0xDC), [0xE0], range(0xE3, 0xEA), range(0xEA, 0xEE))
):
    _SCRIPT_OF[list(_bytes)] = _k

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(b"#*$%&|<>")] = True
_IS_CHAR = (np.arange(256) & 0xC0) != 0x80

_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("lang", pa.string()), ("script", pa.string())]
    + [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens")]
    + [("token_entropy", pa.float64())]
)


class Pieces:
    """The pieces of words under a sentencepiece model; each distinct word is split once while it is
    remembered."""

    def __init__(self, vocabulary: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        self.size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.size)])
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.first, self.count, self.chars = (np.zeros(0, np.int64) for _ in range(4))

    def numbers(self, split: list[list[bytes]]) -> np.ndarray:
        """A number for each word of each text, end to end."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        new = list(set().union(*split) - self.known.keys())
        if new:
            words = [w.decode("utf8", "replace") for w in new]
            ids = self.model.encode(words, num_threads=1)
            count = np.array([len(x) for x in ids], np.int64)
            first = len(self.flat) + np.cumsum(count) - count
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.flat = np.concatenate([self.flat, *[np.array(x, np.int64) for x in ids]])
            self.first, self.count = np.concatenate([self.first, first]), np.concatenate([self.count, count])
            self.chars = np.concatenate([self.chars, np.array([len(w) for w in words], np.int64)])
        get = self.known.__getitem__
        total = sum(map(len, split))
        return np.fromiter((get(w) for words in split for w in words), np.int64, total)


def repeated(words: np.ndarray, doc: np.ndarray, rows: int, window: int = WINDOW) -> np.ndarray:
    """Per row, the words that lie in a window found at least twice in the row."""
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(rows, np.int64)
    key = mixed(doc[:n].astype(np.uint64) + np.uint64(1))
    for k in range(window):
        key = mixed(key + words[k : k + n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(doc[:n] == doc[window - 1 :])
    _, inverse, count = np.unique(key[at], return_inverse=True, return_counts=True)
    hit = at[count[inverse] > 1]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + window, -1)
    return np.bincount(doc[np.cumsum(cover)[:-1] > 0], minlength=rows)


def figures(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The counts and figures of every document, from its whole text."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(vocabulary)
        for chunk in chunks(batches):
            data, at = text_bytes(chunk.column("text"))
            rows, raw = chunk.num_rows, data.tobytes()
            texts = [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            split = [t.split() for t in texts]
            n_words = np.array([len(s) for s in split], np.int64)
            doc = np.repeat(np.arange(rows), n_words)
            word = pieces.numbers(split)
            lines = [[x for x in t.split(b"\n") if x.strip()] if b"\n" in t else [] for t in texts]
            tokens = gathered(pieces.flat, pieces.first[word], pieces.count[word])
            of = np.repeat(doc, pieces.count[word])
            n_tokens = np.bincount(of, minlength=rows)
            key, times = np.unique(of * pieces.size + tokens, return_counts=True)
            share = times / n_tokens[key // pieces.size]
            byte_of = np.repeat(np.arange(rows), np.diff(at))
            script = np.bincount(byte_of * (len(SCRIPTS) + 1) + _SCRIPT_OF[data], minlength=rows * (len(SCRIPTS) + 1))
            best = script.reshape(rows, -1)[:, :-1]
            yield batch_of(
                _SCHEMA,
                doc_id=chunk.column("doc_id"), lang=chunk.column("lang"),
                script=[SCRIPTS[k] if any_ else "none" for k, any_ in zip(best.argmax(1), best.any(1))],
                n_words=n_words,
                word_chars=np.bincount(doc, pieces.chars[word], rows).astype(np.int64),
                n_symbols=np.bincount(byte_of[_IS_SYMBOL[data]], minlength=rows),
                n_dup_lines=np.array([len(x) - len(set(x)) for x in lines], np.int64),
                n_repeat_words=repeated(word, doc, rows),
                n_tokens=n_tokens,
                n_byte_tokens=np.bincount(of[pieces.is_byte[tokens]], minlength=rows),
                token_entropy=np.bincount(key // pieces.size, -share * np.log2(share), rows),
            )

    text = "doc_id long, lang string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, n_byte_tokens long, token_entropy double"
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lang.alias("lang")).mapInArrow(measured, text)


def with_ratios(measured: DataFrame) -> DataFrame:
    most = F.log2(F.greatest(F.col("n_tokens"), F.lit(2)))
    return (
        measured.withColumn("group", F.coalesce("lang", "script"))
        .withColumn("length_class", F.floor(CLASSES * most).cast("int"))
        .withColumn("chars_per_token", F.col("word_chars") / F.nullif("n_tokens", F.lit(0)))
        .withColumn("byte_share", F.col("n_byte_tokens") / F.nullif("n_tokens", F.lit(0)))
        .withColumn("entropy_ratio", F.when(F.col("n_tokens") > 1, F.col("token_entropy") / most))
    )


def bands(measured: DataFrame, reach: float) -> DataFrame:
    """The lower and upper end of each figure's band, with the number of documents behind it: per language or
    script and length class, per language or script (length class null), and of all documents (both null)."""
    key = ["group", "length_class"]
    levels = F.array(F.struct(*key), F.struct("group", F.lit(None).cast("int").alias("length_class")), F.struct(F.lit(None).cast("string").alias("group"), F.lit(None).cast("int").alias("length_class")))
    rows = measured.select(*BANDED, F.explode(levels).alias("level")).select(*BANDED, "level.*")
    middle = rows.groupBy(key).agg(F.count("*").alias("documents"), *[F.percentile_approx(f, 0.5, 10_000).alias(f"{f}_mid") for f in BANDED])
    middle = middle.select(*[F.col(c).alias(f"of_{c}") for c in key], "documents", *[f"{f}_mid" for f in BANDED])
    same = F.col("group").eqNullSafe(F.col("of_group")) & F.col("length_class").eqNullSafe(F.col("of_length_class"))
    spread = (
        rows.join(bounded(stored(middle, "middles"), BANDS), same)
        .groupBy(key)
        .agg(
            F.first("documents").alias("documents"),
            *[F.first(f"{f}_mid").alias(f"{f}_mid") for f in BANDED],
            *[F.percentile_approx(F.abs(F.col(f) - F.col(f"{f}_mid")), 0.5, 10_000).alias(f"{f}_mad") for f in BANDED],
        )
    )
    ends = []
    for f in BANDED:
        mid, width = F.col(f"{f}_mid"), F.lit(reach * 1.4826) * F.col(f"{f}_mad")
        least = LEAST_WIDTH[f] * mid if f == "chars_per_token" else F.lit(LEAST_WIDTH[f])
        width = F.greatest(width, least)
        ends += [(mid - width).alias(f"{f}_low"), (mid + width).alias(f"{f}_high")]
    return spread.select(*key, "documents", *ends)


def _chosen(measured: DataFrame, found: DataFrame) -> DataFrame:
    """Per group and length class the band to use: its own, or the wider one if too few documents are behind it."""
    values = F.struct(*[f"{f}_{end}" for f in BANDED for end in ("low", "high")])
    own = found.where("length_class IS NOT NULL").select("group", "length_class", "documents", values.alias("own"))
    wide = found.where("length_class IS NULL AND group IS NOT NULL").select("group", F.col("documents").alias("of_group"), values.alias("wide"))
    every = found.where("group IS NULL AND length_class IS NULL").select(values.alias("every"))
    both = own.join(wide, "group").join(F.broadcast(every))  # one row
    borrowed = (F.col("documents") < LEAST_DOCUMENTS).alias("borrowed")
    best = F.when(F.col("documents") >= LEAST_DOCUMENTS, F.col("own")).when(F.col("of_group") >= LEAST_DOCUMENTS, F.col("wide")).otherwise(F.col("every"))
    return both.select("group", "length_class", borrowed, best.alias("b")).select("group", "length_class", "borrowed", "b.*")


def judge(docs: DataFrame, vocabulary: str, *, reach: float = 6.0) -> DataFrame:
    """Every document with its counts, figures, bands' verdict and ``kept``.

    ``docs`` needs doc_id and text, and lang if there is one; other columns are ignored. A null or
    empty text has no words and fails the base rules. A null language is judged by script. A length class with
    fewer than ``LEAST_DOCUMENTS`` documents is judged by the band of its language or script, such a language
    or script by the band of all documents. A figure
    that does not exist (no tokens) is in every band. Repeated rows come back once each. An empty
    table gives no rows.
    """
    measured = with_ratios(stored(figures(docs, vocabulary), "fertility"))
    found = _chosen(measured, stored(bands(measured, reach), "bands"))
    judged = measured.join(bounded(stored(found, "chosen"), BANDS), ["group", "length_class"], "left")
    within = {f: F.coalesce(F.col(f).between(F.col(f"{f}_low"), F.col(f"{f}_high")), F.lit(True)) for f in BANDED}
    # longer documents have more entropy, but less of what they could have: beside documents of other lengths
    # each end of the band is passed by one of both
    ends = [F.coalesce((F.col(f"entropy_ratio{e}") >= F.col(f"entropy_ratio{x}")) | (F.col(f"token_entropy{e}") >= F.col(f"token_entropy{x}")), F.lit(True)) for e, x in (("", "_low"), ("_high", ""))]
    within["entropy_ratio"] = within["entropy_ratio"] | (F.col("borrowed") & ends[0] & ends[1])
    inside = F.lit(True)
    for f in FIGURES:
        inside = inside & within[f]
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        judged.withColumn("base_failed", failed)
        .withColumn("in_bands", inside)
        .withColumn("kept", ~F.col("base_failed") & F.col("in_bands"))
    )


def op10_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "group", "n_tokens", *FIGURES,
    )
