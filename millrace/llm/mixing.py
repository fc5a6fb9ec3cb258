"""Mix sources to target weights by raking, then sample documents by calibrated probabilities.

Tokens are counted per cell (source x language x topic). Iterative proportional fitting rescales the cell
weights to each target marginal in turn. The weights are scaled to the size of the sample, cells with fewer
tokens than their weight are taken whole, and the others are fitted again under that bound. Weight by tokens is
then the probability with which a document of the cell is taken; none is taken twice. Unless a size is
given, it is the largest one of which at most a share of ``UNREACHED`` lies in cells that are too small: a tiny
cell cannot shrink the sample. All of it is DataFrame expressions; a source with a third of all rows is one cell
row per language and topic.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.session import stage_table

DIMENSIONS = ("source", "lang", "topic")

# Marks of the bundled topics, in order of precedence on ties; ``general`` is the rest.
TOPICS = {
    "legal": ("icense", "opyright", "ights reserved", "arranty"),
    "contact": ("@",),
    "table": (" | ",),
}
WORD = r"\S+"
# Share of the sample that may be missing because cells have too few tokens.
UNREACHED = 0.01
LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class Targets:
    """Shares per dimension: explicit ones, else each value's own token share to the power ``exponents[dim]``.

    An exponent of 1 keeps the natural share, 0 makes all values equal. Shares are scaled to 1 over the
    values that occur; an occurring value that is missing from an explicit table gets none and is never taken.
    """

    shares: dict[str, dict[str, float]] = field(default_factory=dict)
    exponents: dict[str, float] = field(default_factory=lambda: {"source": 0.7, "lang": 0.8, "topic": 1.0})


def token_count(text: Column) -> Column:
    """Words between blanks; 0 for null and blank texts."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _occurrences(text: Column, mark: str) -> Column:
    """How often ``mark`` occurs; literal replacement is several times cheaper than a pattern."""
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark.encode())


def topic_of(text: Column) -> Column:
    """The topic whose marks occur most often; ties go to the first one, no occurrence to ``general``."""
    text = F.coalesce(text, F.lit(""))
    hits = [F.struct(sum((_occurrences(text, m) for m in marks), F.lit(0.0)).cast("long").alias("n"),
                     F.lit(-i).alias("at"), F.lit(t).alias("topic")) for i, (t, marks) in enumerate(TOPICS.items())]
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(1).alias("at"), F.lit("general").alias("topic"))
    return F.greatest(*hits, none)["topic"]


def mixed_features(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """``docs`` as one struct ``doc`` beside ``source``, ``lang``, ``topic`` (null: ``unknown``) and ``tokens``."""
    def known(c):
        return F.coalesce(c, F.lit("unknown"))
    own = F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    return docs.select(own, known(docs["source"]).alias("source"), known(docs["lang"]).alias("lang"),
                       known(topic_of(docs["text"]) if topic is None else topic).alias("topic"),
                       token_count(docs["text"]).alias("tokens"))


def _target_column(dim: str, targets: Targets) -> Column:
    """Unscaled target of the row's value in ``dim``, from the natural share in ``n_<dim>``."""
    if dim not in targets.shares:
        return F.pow(F.col("n_" + dim) / F.col("n_all"), F.lit(targets.exponents.get(dim, 1.0)))
    table = F.create_map(*[F.lit(x) for kv in targets.shares[dim].items() for x in (kv[0], float(kv[1]))])
    return F.coalesce(F.try_element_at(table, F.col(dim)), F.lit(0.0))


def rake(cells: DataFrame, targets: Targets, rounds: int = 12) -> DataFrame:
    """Fit ``cells(source, lang, topic, tokens)`` to the targets; adds ``weight`` and ``ratio`` (weight / tokens).

    Cells are few (occurring combinations only). Every round rescales to source, language and topic; one
    round is three windows over the cells. Weights are rounded to six digits of a token after each
    rescaling, so the order of summation cannot change them.
    """
    out = cells.where(F.col("tokens") > 0)
    out = out.withColumn("n_all", F.sum("tokens").over(W.partitionBy(F.lit(0))))
    for dim in DIMENSIONS:
        out = out.withColumn("n_" + dim, F.sum("tokens").over(W.partitionBy(dim)).cast("double"))
    for dim in DIMENSIONS:
        out = out.withColumn("t_" + dim, _target_column(dim, targets))
        # each value counts once in the scale, spread over its cells by tokens
        scale = F.sum(F.col("t_" + dim) * F.col("tokens") / F.col("n_" + dim)).over(W.partitionBy(F.lit(0)))
        out = out.withColumn("t_" + dim, F.round(F.col("t_" + dim) / F.nullif(scale, F.lit(0.0)), 12))
    out = out.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for dim in DIMENSIONS:
            have = F.nullif(F.sum("weight").over(W.partitionBy(dim)), F.lit(0.0))
            out = out.withColumn("weight", F.coalesce(F.round(
                F.col("weight") * F.col("t_" + dim) * F.col("n_all") / have, 6), F.lit(0.0)))
    return out.select(*DIMENSIONS, "tokens", "weight", (F.col("weight") / F.col("tokens")).alias("ratio"))


def calibrated(raked: DataFrame, size: float | None = None, unreached: float = UNREACHED, rounds: int = 12) -> DataFrame:
    """Chances of the cells of ``rake``: dimensions, tokens, wanted, taken (expected tokens), chance.

    ``size`` is the tokens wanted in all; by default the most of which a share of ``unreached`` or less is not
    there when each cell gives its weight or all it has. What cells lack is made up by others of their
    source, language and topic; what these lack too is the difference of wanted and taken. With
    ``unreached`` 0 all targets are met, and the cell of the largest ratio sets the size.
    """
    everything = W.partitionBy(F.lit(0))
    out = raked.withColumn("n_all", F.sum("tokens").over(everything))
    if size is not None:
        out = out.withColumn("scale", F.least(F.lit(float(size)) / F.col("n_all"), F.lit(1.0)))
    else:
        # What is missing at a scale is the most that any of the first cells by ratio lack together.
        first = everything.orderBy(F.desc("ratio"), *DIMENSIONS).rowsBetween(W.unboundedPreceding, 0)
        spare = F.sum("weight").over(first) - F.lit(float(unreached)) * F.col("n_all")
        out = out.withColumn("most", F.when(spare > 0, F.sum("tokens").over(first) / spare))
        out = out.withColumn("scale", F.least(F.min("most").over(everything), F.lit(1.0)))
    out = out.withColumn("wanted", F.round(F.col("weight") * F.col("scale"), 6)).withColumn("open", F.col("wanted"))
    taken = F.least("open", F.col("tokens").cast("double"))
    if size is not None or unreached > 0:
        for _ in range(rounds):
            for dim in DIMENSIONS:
                per = W.partitionBy(dim)
                lift = F.sum("wanted").over(per) / F.nullif(F.sum(taken).over(per), F.lit(0.0))
                # Cells taken whole stay whole; the bound only keeps the number finite.
                out = out.withColumn("open", F.least(
                    F.coalesce(F.round(F.col("open") * lift, 6), F.lit(0.0)), F.col("tokens") * F.lit(1e6)))
    return out.select(*DIMENSIONS, "tokens", "wanted", taken.alias("taken"),
                      F.round(taken / F.col("tokens"), 9).alias("chance"))


def missing_share(cells: DataFrame) -> float:
    """Share of the wanted tokens that ``calibrated`` cells lack, the largest of the three dimensions."""
    lacks = []
    for dim in DIMENSIONS:
        by = cells.groupBy(dim).agg(F.sum("wanted").alias("wanted"), F.sum("taken").alias("taken"))
        lacks.append(by.agg((F.sum(F.greatest(F.col("wanted") - F.col("taken"), F.lit(0.0))) /
                             F.nullif(F.sum("wanted"), F.lit(0.0))).alias("lack")))
    return lacks[0].union(lacks[1]).union(lacks[2]).agg(F.max("lack")).first()[0] or 0.0


def draw(doc_id: Column, text: Column, salt: str) -> Column:
    """A number in [0, 1) that depends on the id (of a null id: on the text) and the salt only."""
    key = F.concat(F.lit(salt + ":"), F.coalesce(doc_id.cast("string"), text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def sampling_table(docs: DataFrame, targets: Targets | None = None, topic: Column | None = None,
                   rounds: int = 12, salt: str = "mix", size: float | None = None,
                   unreached: float = UNREACHED) -> DataFrame:
    """Every document with its cell and chance: doc (all its columns), source, lang, topic, tokens, probability, kept.

    ``size`` and ``unreached`` as in ``calibrated``; the share that is not reached is logged.

    One row per input row. Documents without words have probability 1: they weigh nothing. Repeated rows of
    one id share one draw. An empty table gives no rows. ``docs`` needs doc_id, text, source and lang; further
    columns, whatever their names, stay inside ``doc``.
    """
    marked = mixed_features(docs, topic)
    raked = stage_table(rake(stage_table(marked.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells"),
                             targets or Targets(), rounds), "raked")
    if size is None and unreached == 0:
        top = raked.agg(F.max("ratio").alias("top"))
        chance = raked.select(*DIMENSIONS, F.round(F.col("ratio") / F.nullif(top.scalar(), F.lit(0.0)), 9)
                              .alias("chance"))
    else:
        cells = stage_table(calibrated(raked, size, unreached, rounds), "calibrated")
        LOG.info("mixing: a share of %.6f of the sample is not reached", missing_share(cells))
        chance = cells.select(*DIMENSIONS, "chance")
    out = marked.join(chance, list(DIMENSIONS), "left").select(
        "doc", *DIMENSIONS, "tokens", F.when(F.col("tokens") == 0, 1.0).otherwise(
            F.coalesce("chance", F.lit(0.0))).alias("probability"))
    return out.withColumn("kept", draw(F.col("doc.doc_id"), F.col("doc.text"), salt) < F.col("probability"))


def sample_mixture(docs: DataFrame, **options) -> DataFrame:
    """The documents drawn by ``sampling_table``, with the columns of ``docs``."""
    return sampling_table(docs, **options).where("kept").select("doc.*")
