"""Fill-in-the-middle documents, cut at token ends that a wavelet matrix finds.

Every byte of a text has a class of three bits: is it white space, does it begin a code point, does it end a
token. A wavelet matrix over the classes of all texts of a chunk answers, for any place, how many bytes of a
class lie before it. Ranks of the classes that end a token add up to the tokens before a place, ranks of those
that begin a code point to the code points. A cut after k tokens is found by bisection on that count, for all
texts of the chunk at once; characters before a cut are one more rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import SPACES, chunks, documents, text_bytes

#: Bits of a class, the first level of the matrix first.
SPACE, BEGINS, ENDS = 4, 2, 1
#: Prefix, suffix and middle follow these.
MARKERS = ("<P>", "<S>", "<M>")


class Bits:
    """A bit string with ranks: ones before each block of 64 bits, and the bits of the block."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, "<u8")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words), np.int64)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])

    def ones(self, place: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class WaveletMatrix:
    """Symbols of ``levels`` bits, sorted stably by one bit after the other from the highest down."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.bits, self.zeros = levels, [], []
        for level in reversed(range(levels)):
            one = (symbols >> level & 1).astype(bool)
            self.bits.append(Bits(one))
            self.zeros.append(len(one) - int(one.sum()))
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def _down(self, symbol: int, place: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(zip(self.bits, self.zeros)):
            ones = bits.ones(place)
            place = zeros + ones if symbol >> (self.levels - 1 - k) & 1 else place - ones
        return place

    def rank(self, symbol: int, place: np.ndarray) -> np.ndarray:
        """How often the symbol stands before each place."""
        return self._down(symbol, place) - self._down(symbol, np.zeros(1, np.int64))

    def having(self, bit: int, place: np.ndarray) -> np.ndarray:
        """Symbols with this bit before each place: the ranks of all of them."""
        return sum(self.rank(s, place) for s in range(1 << self.levels) if s & bit)

    def after(self, bit: int, count: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The least place from ``first`` to ``last`` with ``count`` symbols having the bit since ``first``,
        by bisection."""
        low, high, want = first.copy(), last.copy(), self.having(bit, first) + count
        while (low < high).any():
            middle = (low + high) // 2
            enough = self.having(bit, middle) >= want
            high = np.where(enough, middle, high)
            low = np.where(enough, low, np.minimum(middle + 1, high))
        return low


def classes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The class of every byte of texts that lie end to end and begin at ``at``.

    A token is a run of white space and the word after it, or white space at the end of a text: it ends where a
    word ends and where a text ends.
    """
    space = SPACES[data]
    last = np.zeros(len(data), bool)
    last[at[1:][np.diff(at) > 0] - 1] = True
    next_space = np.append(space[1:], False)
    ends = last | (~space & next_space)
    return (space * SPACE + ((data & 0xC0) != 0x80) * BEGINS + ends * ENDS).astype(np.uint8)


def cut(data: np.ndarray, at: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """Tokens of each text, the places of both cuts, and the code points before each cut.

    The cuts come after the smaller and the larger of ``first`` and ``second`` modulo the tokens plus one.
    """
    matrix = WaveletMatrix(classes(data, at), 3)
    begin, end = at[:-1], at[1:]
    n = matrix.having(ENDS, end) - matrix.having(ENDS, begin)
    a, b = first % (n + 1), second % (n + 1)
    places = [matrix.after(ENDS, k, begin, end) for k in (np.minimum(a, b), np.maximum(a, b))]
    points = [matrix.having(BEGINS, p) - matrix.having(BEGINS, begin) for p in places]
    return n, *places, *points


def transform(docs: DataFrame, *, seed: int = 42, percent: int = 50, suffix_first: int = 80, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars and output of every document.

    The first 32 hex digits of SHA-256 of ``seed:doc_id`` are four numbers: two choose the cuts, the third
    whether the text is cut (``percent`` of them are), the fourth whether the suffix comes first (``spm``, of
    ``suffix_first`` percent) or the prefix (``psm``). Whole texts are kept as ``plain`` where they are not chosen,
    empty, or hold a marker; the two lengths are null then.

    ``docs`` needs doc_id and text; other columns are ignored. A null text is empty, a null doc_id counts as an
    empty one. White space alone is one token. Repeated rows come back once each, with equal results. An
    empty table gives no rows. A text is worked on whole, in one task, at a few bytes of memory per byte.
    """
    p, s, m = (x.encode() for x in markers)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            data, at = text_bytes(chunk.column("text"))
            h = [chunk.column(f"h{k}").to_numpy() for k in range(1, 5)]
            n, one, two, chars, more = cut(data, at, h[0], h[1])
            whole = data.tobytes()
            form, output = [], []
            for k, (a, x, y, b) in enumerate(zip(at[:-1].tolist(), one.tolist(), two.tolist(), at[1:].tolist())):
                if a == b or h[2][k] % 100 >= percent or any(whole.find(t, a, b) >= 0 for t in (p, s, m)):
                    form.append("plain")
                    output.append(whole[a:b])
                elif h[3][k] % 100 < suffix_first:
                    form.append("spm")
                    output.append(b"".join((s, whole[y:b], p, whole[a:x], m, whole[x:y])))
                else:
                    form.append("psm")
                    output.append(b"".join((p, whole[a:x], s, whole[y:b], m, whole[x:y])))
            plain = np.array([f == "plain" for f in form], bool)
            columns = [pa.array(n), pa.array(form, pa.string()), pa.array(chars, mask=plain), pa.array(more - chars, mask=plain), pa.array(output, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), *columns], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *numbers)
    return wanted.mapInArrow(made, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``transform`` was given, from its output and form."""
    p, s, m = markers
    after = lambda mark: F.substring_index(output, mark, -1)
    until = lambda part, psm, spm: F.when(form == "psm", F.substring_index(part, psm, 1)).otherwise(F.substring_index(part, spm, 1))
    joined = F.concat(until(after(p), s, m), after(m), until(after(s), m, p))
    return F.when(form == "plain", output).otherwise(joined)


def op12_wavelet_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transform(documents(spark, sf_dir))
    text = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


#: The same by lists of tokens.
OP12_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), numbered AS (
  SELECT *, len(units) AS n,
         CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4
  FROM cut
), parts AS (
  SELECT doc_id, n, body,
         array_to_string(units[1 : least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
         array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1 : greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
         array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1 : n], '') AS suffix,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM numbered
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""
