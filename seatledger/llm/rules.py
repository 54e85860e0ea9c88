"""Operator 6: quality rules whose thresholds adapt to language and source.

Measures of whole texts become whole numbers, and those are counted in the bins of a
logarithmic histogram: 32 bins for every power of two, exact below 64. Such counts are a
quantile sketch with a relative error below 1/32 that merges by addition, in any order and
with equal results: map tasks send one count per (group, bin). Quantiles are interpolated
inside their bin.

Measures are dense, so that ordinary documents spread over many bins: the share of
punctuation rather than of odd symbols, the share of the commonest word rather than of
repeated lines. A threshold is then a far-out fence above the bulk of its group, from two
quantiles of the sketch and nothing else. Both lie in the lower half, which junk with high
measures can't move much while it is at most half of the group. The sketch of a source is
merged with ``PRIOR`` documents' worth of its language's, and that of a language with as
much of the whole, so small groups lean on larger ones by their size. A group that shares
the level of the next larger one (its low quantile is not above that one's centre) is also
bound by that one's fence, so a source with more junk than half gets no looser rule; a
group that lies higher as a whole keeps its own. Verdicts come from a join of measures with
thresholds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatledger.llm.components import stored
from seatledger.llm.quality import _repeats
from seatledger.llm.text import blocks, window_hashes, window_rows, word_hashes, word_spans

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, REPEAT_PERCENT = 10, 20
#: Documents' worth of the next larger group's sketch that a group's own is merged with.
PRIOR = 20
#: Quantiles (per mille) whose distance, FENCE times, is added to the centre.
LOW, CENTRE, FENCE = 100, 400, 10
#: Bins for a power of two, as a power of two.
DETAIL = 5
#: Weights in a merged sketch are whole numbers in this unit.
UNIT = 1_000_000

#: Measures as whole numbers. A count c of the commonest word stands as c - 2 sqrt(c): its
#: excess over chance, so that a few words are no share.
MEASURES = {
    "symbol_share": "n_punctuation * 100000 div word_chars",
    "word_share": "cast(greatest(n_commonest - 2 * sqrt(n_commonest), 0d) * 100000 / n_words as bigint)",
    "word_length": "(word_chars - n_punctuation) * 1000 div n_words",
    "capital_share": "n_capitals * 100000 div word_chars",
}

_FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_punctuation", "n_capitals", "n_commonest"]
#: ASCII characters that are no letter, digit or control.
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def _commonest(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """How often the commonest word of each row occurs."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1]))) if len(h) else np.zeros(0, np.int64)
    out = np.zeros(n, np.int64)
    np.maximum.at(out, r[first], np.diff(np.append(first, len(h))))
    return out


def _measured(data: np.ndarray, borders: np.ndarray) -> list[np.ndarray]:
    n = len(borders) - 1
    starts, ends, firsts = word_spans(data, borders)
    counts = np.diff(firsts)
    rows = np.repeat(np.arange(n), counts)

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[borders[1:]] - sums[borders[:-1]]

    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=letters[1:])
    chars = np.bincount(rows, letters[ends] - letters[starts], n).astype(np.int64)
    hashes = word_hashes(data, starts, ends)
    at, own = window_rows(firsts, 5, len(hashes))
    _, _, again = _repeats(window_hashes(hashes, 5)[at] if len(at) else np.zeros(0, np.uint64), own, n)
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + 5, -1)
    repeated = np.bincount(rows, np.cumsum(cover)[:-1] > 0, n).astype(np.int64)
    dup = np.zeros(n, np.int64)
    raw = data.tobytes()
    for k in range(n):
        own_lines = [x for x in raw[borders[k] : borders[k + 1]].split(b"\n") if x.strip()]
        dup[k] = len(own_lines) - len(set(own_lines))
    symbols, marks = (per_row(np.isin(data, np.frombuffer(x, np.uint8))) for x in (SYMBOLS, PUNCTUATION))
    capitals = per_row((data >= 65) & (data <= 90))
    return [counts, chars, symbols, dup, repeated, marks, capitals, _commonest(hashes, rows, n)]


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in _FIELDS]))
def base_measures(texts: pa.Array) -> pa.Array:
    parts = [pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in _measured(d, b)], _FIELDS) for _, d, b in blocks(texts)]
    kind = pa.struct([(c, pa.int64()) for c in _FIELDS])
    return pa.concat_arrays([pa.array([], kind), *parts])


def sketch_bin(value: Column) -> Column:
    """Bin of a whole number: itself below 64, then 32 bins for every power of two."""
    step = F.length(F.bin(value)) - (DETAIL + 1)
    return F.when(value < 2 << DETAIL, value).otherwise(step * (1 << DETAIL) + F.call_function("shiftright", value, step))


def bin_top(b: Column) -> Column:
    """Largest number of a bin."""
    power = F.floor(b / (1 << DETAIL)) - 1
    top = F.call_function("shiftleft", (b % (1 << DETAIL) + (1 << DETAIL) + 1).cast("bigint"), power.cast("int")) - 1
    return F.when(b < 2 << DETAIL, b).otherwise(top)


def _quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Both quantiles of every (group, measure) of a sketch (by, measure, bin, w), interpolated."""
    order = Window.partitionBy(*by, "measure").orderBy("bin")
    whole = Window.partitionBy(*by, "measure")
    ranked = sketch.select("*", F.sum("w").over(order).alias("_upto"), F.sum("w").over(whole).alias("_all"))
    bottom = F.when(F.col("bin") > 0, bin_top(F.col("bin") - 1) + 1).otherwise(0)

    def at(q: int) -> Column:
        rank = F.col("_all") * F.lit(q / 1000)
        inside = bottom + (rank - (F.col("_upto") - F.col("w"))) / F.col("w") * (bin_top(F.col("bin")) - bottom)
        return F.min_by(inside, F.when(F.col("_upto") >= rank, F.col("bin")))

    return ranked.groupBy(*by, "measure").agg(at(LOW).alias("low"), at(CENTRE).alias("centre"))


def _leaning(own: DataFrame, by: list[str], larger: DataFrame, shared: list[str], prior: int) -> DataFrame:
    """Sketches of ``own`` merged with ``prior`` documents' worth of the larger group's."""
    sizes = larger.groupBy(*shared, "measure").agg(F.sum("n").alias("_size"))
    share = larger.join(sizes, [*shared, "measure"]).withColumn("w", F.expr(f"n * {prior * UNIT} div _size"))
    lent = own.select(*by, "measure").distinct().join(share.select(*shared, "measure", "bin", "w"), [*shared, "measure"])
    kept = own.select(*by, "measure", "bin", (F.col("n") * UNIT).alias("w"))
    return kept.unionByName(lent.select(*kept.columns)).groupBy(*by, "measure", "bin").agg(F.sum("w").alias("w")).where("w > 0")


def thresholds(measured: DataFrame, prior: int = PRIOR) -> DataFrame:
    """(lang, source, measure, threshold) from rows (lang, source, measure, value)."""
    source = measured.groupBy("lang", "source", "measure", sketch_bin(F.col("value")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    source = stored(source, "sketches")
    lang = source.groupBy("lang", "measure", "bin").agg(F.sum("n").alias("n"))
    every = lang.groupBy("measure", "bin").agg(F.sum("n").alias("n"))

    def level(sketch: DataFrame, by: list[str], name: str) -> DataFrame:
        fence = F.col("centre") + (F.col("centre") - F.col("low")) * FENCE
        return _quantiles(sketch, by).select(
            *by, "measure", fence.alias(f"_{name}"), F.col("low").alias(f"_{name}_low"), F.col("centre").alias(f"_{name}_centre")
        )

    def bound(name: str, larger: Column, centre: str) -> Column:
        own = F.col(f"_{name}")
        return F.when(F.col(f"_{name}_low") <= F.col(centre), F.least(own, larger)).otherwise(own)

    whole = level(every.select("measure", "bin", (F.col("n") * UNIT).alias("w")), [], "all")
    langs = level(_leaning(lang, ["lang"], every, [], prior), ["lang"], "lang")
    sources = level(_leaning(source, ["lang", "source"], lang, ["lang"], prior), ["lang", "source"], "source")
    joined = sources.join(langs, ["lang", "measure"]).join(whole, "measure")
    limit = bound("source", bound("lang", F.col("_all"), "_all_centre"), "_lang_centre")
    return joined.select("lang", "source", "measure", limit.alias("threshold"))


def apply_rules(docs: DataFrame, prior: int = PRIOR) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, failed`` per row; ``failed`` lists the measures above their threshold.

    A document fails the base rules with fewer than 10 words or over 20 % repeated words;
    such documents form no thresholds. Null and empty texts have no words and fail. Null
    languages and sources are groups of their own; rows without id are judged like others,
    repeated rows alike. Other columns are ignored.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("?")).alias(c)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), name("lang"), name("source"), base_measures("text").alias("_m"))
    rows = rows.select("doc_id", "lang", "source", "_m.*").withColumn(
        "base_failed", (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    )
    rows = stored(rows, "measures")
    pairs = F.array(*(F.struct(F.lit(k).alias("measure"), F.expr(e).alias("value")) for k, e in MEASURES.items()))
    good = rows.where(~F.col("base_failed"))
    measured = good.select("lang", "source", F.explode(pairs).alias("_p")).select("lang", "source", "_p.*")
    limits = thresholds(measured, prior)
    wide = limits.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("measure") == k, F.col("threshold"))).alias(f"_t_{k}") for k in MEASURES)
    )
    # Stored, its true size lets Spark broadcast it, so that a hot source is not shuffled to one task.
    wide = stored(wide, "limits")
    over = F.filter(
        F.array(*(F.when(F.expr(e) > F.col(f"_t_{k}"), F.lit(k)) for k, e in MEASURES.items())), lambda x: x.isNotNull()
    )
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = good.join(wide, ["lang", "source"]).withColumn("failed", over).select(*base, (F.size("failed") == 0).alias("kept"), "failed")
    failed = rows.where("base_failed").select(*base, F.lit(False).alias("kept"), F.array().cast("array<string>").alias("failed"))
    return judged.unionByName(failed)
