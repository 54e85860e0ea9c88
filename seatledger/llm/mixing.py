"""Operator 3: mix sources to target weights under a token budget.

Leaves are the distinct combinations of the level columns (domain, language, source). The
budget goes down the tree: at every node it is shared among the children by weight, a child
that can't use its share (its leaves' tokens times ``epochs``) is filled up and what it
leaves goes to its siblings; only what the whole family can't use goes back to the family's
own siblings, one level up. Capping every node by the capacity of its subtree before its
family is shared out does just that, in one window per level over node rows.

A leaf streams its documents in epochs, each in an own order seeded by (seed, epoch,
document), and takes the prefix of its quota in tokens: whole epochs, then a prefix of the
next, whose last document may be cut. Texts are read twice: once for a slim table of their
token counts and hashes, once for the result. The prefix of a leaf that holds a third of all
rows needs no sort of the leaf: the place where its quota ends is found digit by digit, by
token counts of the first three hexadecimal digits of the order, then of the next three
where those end, then of single documents, about one in 16 million of the leaf.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatledger.llm.components import stored
from seatledger.llm.text import WORD, words

LEVELS = ("domain", "lang", "source")
#: Digits of the order (32 in all) known after each round of the search for a quota's end.
DIGITS = (3, 6, 32)
#: Bytes of a table of leaves that may be broadcast; beyond, the joins shuffle.
BROADCAST_BYTES = 32 << 20


def token_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _weight(name: Column, weights: Mapping[str, int]) -> Column:
    """The node's weight by its name; ``*`` gives the weight of all others (1 if absent)."""
    rest = F.lit(weights.get("*", 1))
    named = [F.lit(x) for k, v in weights.items() if k != "*" for x in (k, v)]
    return (F.coalesce(F.create_map(*named)[name], rest) if named else rest).cast("bigint")


def _shared_out(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Nodes (parent columns, name, weight, cap, parent budget) with their ``quota``.

    Children fill up in the order of cap / weight; the first that can use its share and all
    after it divide what is left. Quotas are whole tokens and add up to the smaller of the
    parent's budget and the children's capacity.
    """
    order = Window.partitionBy(*parent).orderBy((F.col("cap") / F.col("weight")), name)
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    family = Window.partitionBy(*parent)
    big = lambda c: c.cast("decimal(19,0)")
    zero = F.lit(0).cast("bigint")
    step = nodes.select(
        "*",
        (F.col("budget") - F.coalesce(F.sum("cap").over(before), zero)).alias("_left"),
        (F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), zero)).alias("_weights"),
    )
    step = step.withColumn("_full", (big(F.col("cap")) * big(F.col("_weights")) <= big(F.col("weight")) * big(F.col("_left"))) & (F.col("_left") >= 0))
    step = step.withColumn("_full", F.min("_full").over(upto))
    step = step.withColumn("_rest", F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(family), zero))
    step = step.withColumn("_open", F.when(F.col("_full"), zero).otherwise(F.col("weight")))
    step = step.withColumn("_open_upto", F.sum("_open").over(upto)).withColumn("_open_all", F.sum("_open").over(family))
    share = F.expr(
        "cast(_rest as decimal(19,0)) * cast(_open_upto as decimal(19,0)) div nullif(_open_all, 0)"
        " - cast(_rest as decimal(19,0)) * cast(_open_upto - _open as decimal(19,0)) div nullif(_open_all, 0)"
    )
    quota = F.when(F.col("_full"), F.col("cap")).otherwise(F.greatest(zero, F.coalesce(share, zero)))
    return step.withColumn("quota", quota.cast("bigint")).drop("_left", "_weights", "_full", "_rest", "_open", "_open_upto", "_open_all")


def leaf_quotas(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], budget: int | None, share: float, epochs: int, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Leaves (levels, tokens) with their ``quota``; ``budget`` None means ``share`` of all tokens."""
    caps = leaves.select(*levels, "tokens", (F.col("tokens") * epochs).alias("cap"))
    whole = F.lit(budget).cast("bigint") if budget is not None else F.floor(F.sum("tokens") * F.lit(share))
    # The root and the first level are a few rows: one for each domain.
    parents = caps.agg(F.least(whole, F.sum("cap")).alias("quota"))
    for depth, name in enumerate(levels):
        above, own = list(levels[:depth]), list(levels[: depth + 1])
        nodes = caps.groupBy(*own).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(F.col(name), weights.get(name, {})))
        budgets = parents.select(*above, F.col("quota").alias("budget"))
        nodes = nodes.join(budgets, above) if above else nodes.withColumn("_", F.lit(1)).join(F.broadcast(budgets.withColumn("_", F.lit(1))), "_").drop("_")
        parents = _shared_out(nodes, above, name).select(*own, "quota")
    return leaves.join(parents, list(levels))


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its underscore columns under other names, and the name of each column."""
    taken = {c.lower() for c in docs.columns}
    names = {}
    for c in docs.columns:
        other = c
        while c.startswith("_") and (other == c or other.lower() in taken):
            other = f"aside{other}"
        taken.add(other.lower())
        names[c] = other
    return docs.withColumnsRenamed({c: n for c, n in names.items() if c != n}), names


def mix(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, int]],
    levels: Mapping[str, Column],
    budget: int | None = None,
    share: float = 0.5,
    epochs: int = 2,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that the mixture takes, all columns, once for every epoch, with
    ``_domain, ...`` (an underscore before each level's name), ``_epoch, _tokens, _take``.

    ``_take`` is below ``_tokens`` only for the document in which a leaf's quota ends. Names
    of levels are compared as text; null is the name ``?``. Weights are whole numbers of at
    least 1. Null and empty texts have no tokens: they cost nothing and come with every
    whole epoch, and with a partial one when they stand before its end. Ties in the order
    (equal id and text) are interchangeable rows. Columns of ``docs`` that begin with an
    underscore are kept under their names, unless the result has one of that name itself:
    such a column is left out (:func:`mixed_rows` keeps it). An empty table gives no rows.
    """
    added = {*(f"_{k}".lower() for k in levels), "_epoch", "_tokens", "_take"}
    stays = [c for c in docs.columns if c.lower() not in added]
    docs, names_of = _aside(docs)
    names = [f"_{k}" for k in levels]
    own = {f"_{k}": F.coalesce(v.cast("string"), F.lit("?")) for k, v in levels.items()}
    named = docs.select("*", *(c.alias(n) for n, c in own.items()))
    text = F.col(text_col)
    # An order for every epoch follows from one hash of the row; digits keep their order as text.
    row_hash = F.md5(F.concat_ws("\x1f", F.lit(seed), F.col(id_col), text))
    order = F.md5(F.concat_ws("\x1f", F.col("_whole"), F.col("_hash")))
    slim = stored(named.select(*names, row_hash.alias("_hash"), token_count(text).alias("_tokens")), "tokens")
    leaves = stored(slim.groupBy(*names).agg(F.sum("_tokens").alias("tokens")), "leaves")
    quotas = leaf_quotas(leaves, {f"_{k}": v for k, v in weights.items()}, budget, share, epochs, names)
    cut = quotas.select(
        *names, "quota", "tokens",
        F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(F.lit(1)).alias("_whole"),
        F.when(F.col("tokens") > 0, F.col("quota") % F.col("tokens")).otherwise(F.lit(0)).alias("_part"),
    )
    cut = stored(cut, "quotas")
    size = leaves.agg(F.sum(sum((F.octet_length(n) for n in names), F.lit(100)))).first()[0] or 0
    at_leaf = lambda table: F.broadcast(table) if size <= BROADCAST_BYTES else table

    ends = cut.where("_part > 0").select(*names, "_whole", "_part", F.lit("").alias("_end"), F.lit(0).cast("bigint").alias("_before"))
    running = Window.partitionBy(*names).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    for digits in DIGITS:
        inside = slim.join(at_leaf(ends), names).withColumn("_order", order).where(F.col("_order").startswith(F.col("_end")))
        counted = inside.groupBy(*names, "_whole", "_part", "_before", F.substring("_order", 1, digits).alias("_at")).agg(F.sum("_tokens").alias("_n"))
        counted = counted.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_n").over(running), F.lit(0)))
        ends = counted.where("_before < _part and _before + _n >= _part").select(*names, "_whole", "_part", F.col("_at").alias("_end"), "_before")
        ends = stored(ends, "ends")
    state = stored(cut.join(ends.select(*names, "_end", "_before"), names, "left").select(*names, "_whole", "_part", "_end", "_before"), "state")

    rows = named.withColumn("_hash", row_hash).join(at_leaf(state), names).withColumn("_order", order)
    taken = rows.where("_whole > 0 or _order < _end").withColumn("_tokens", token_count(text))
    last = F.when(F.col("_order") < F.col("_end"), F.col("_whole")).otherwise(F.col("_whole") - 1)
    full = taken.withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).withColumn("_take", F.col("_tokens"))

    # The rows in which a quota ends: one a leaf, or the copies of one.
    border = rows.where("_order = _end").withColumn("_tokens", token_count(text))
    copy = F.row_number().over(Window.partitionBy(*names).orderBy("_order")) - 1
    border = border.withColumn("_left", F.col("_part") - F.col("_before") - F.col("_tokens") * copy)
    partial = border.where("_left > 0").withColumn("_epoch", F.col("_whole")).withColumn("_take", F.least("_tokens", "_left"))
    columns = [*(F.col(names_of[c]).alias(c) for c in stays), *names, "_epoch", "_tokens", "_take"]
    return full.select(*columns).unionByName(partial.select(*columns))


def mixed_rows(docs: DataFrame, weights: Mapping[str, Mapping[str, int]], levels: Mapping[str, Column], **how) -> DataFrame:
    """The rows of :func:`mix` with the columns of ``docs`` alone, whatever their names, and a
    text cut where a quota ends inside it; ``n_chars``, if there is one, follows the cut."""
    hidden, names = _aside(docs)
    taken = mix(hidden, weights, levels, **how)
    whole = F.col("_take") >= F.col("_tokens")
    out = taken.withColumn("text", cut_text(F.col("text"), F.col("_tokens"), F.col("_take")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(length))
    return out.select(*(F.col(n).alias(c) for c, n in names.items()))


def cut_text(text: Column, tokens: Column, take: Column) -> Column:
    """``text``, or its first ``take`` words joined by blanks where a quota ends inside it."""
    return F.when(take >= tokens, text).otherwise(F.array_join(F.slice(words(text), F.lit(1), take.cast("int")), " "))
