"""Permutation importance over sequence windows.

For every feature, each sample takes that feature's whole window (all T
steps) from another sample; importance is the mean absolute change of the
predictions, normalised to sum 1.

The permutation is one seeded shuffle of all samples, at every size: a sample's
place in one hashed order receives from the sample of the same place in another.
Places come from ``sequence_index`` over ranges of the hash, so no task holds a
whole feature.  Only keys are permuted; a donor ships the T values of its one
feature, the unpermuted prediction is made once per sample, and the permuted
vectors are built and scored inside the map stage.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climark.functions.numeric import float_div
from climark.operators.sequences import sequence_index


def donor_keys(win: DataFrame, features: list[str], key: list[str], seed: int = 123) -> DataFrame:
    """(feature, key..., _d_<key>...): for every feature a bijection of the samples."""
    feats = win.select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"), *key)

    def placed(salt: int) -> DataFrame:
        hashed = feats.withColumn("_h", F.xxhash64(F.lit(seed + salt), "feature", *key))
        return sequence_index(hashed, ["feature"], ["_h", *key], F.shiftright("_h", 54), name="_p")

    donors = placed(2).select("feature", "_p", *[F.col(k).alias(f"_d_{k}") for k in key])
    return placed(1).select("feature", "_p", *key).join(donors, ["feature", "_p"]).drop("_p")


def _values(win: DataFrame, features: list[str], key: list[str]) -> DataFrame:
    """(feature, _d_<key>..., vals): the window of one feature of each sample."""
    return win.select(*[F.col(k).alias(f"_d_{k}") for k in key], F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.lit(d).alias("place"), _column("seq", f).alias("vals"))
        for d, f in enumerate(features)])))


def _column(seq: str, feature: str):
    return F.transform(seq, lambda s: s[feature])


def _swapped(width: int):
    """The flat window ``x`` with place ``place`` of every step taken from ``vals``."""
    return F.transform("x", lambda v, i: F.when(i % width == F.col("place"), F.get(
        F.col("vals"), F.floor(i / width).cast("int"))).otherwise(v))


def permuted_join(win: DataFrame, features: list[str], key: list[str], seed: int = 123) -> DataFrame:
    """(feature, keys..., x, perm_x): each sample's flat window and the same with
    ``feature`` taken from its donor."""
    given = donor_keys(win, features, key, seed).join(
        _values(win, features, key), ["feature", *[f"_d_{k}" for k in key]])
    x = win.select(*key, F.flatten(F.transform("seq", lambda s: F.array(*[s[c] for c in features]))).alias("x"))
    return given.join(x, key).select("feature", *key, "x", _swapped(len(features)).alias("perm_x"))


def permutation_importance(win: DataFrame, model, features: list[str], key: list[str], targets: list[str],
                           seed: int = 123) -> DataFrame:
    """(Variable, Importancia) per feature; ``model`` is a MultiTarget.  For a model whose
    forecasts follow no feature there is nothing to normalise by: NaN, as in the reference."""
    flat = F.flatten(F.transform("seq", lambda s: F.array(*[s[c] for c in features])))
    once = model.transform(win.select(*key, flat.alias("x")).withColumn("features", array_to_vector("x"))).select(
        *key, "x", *[F.col(f"pred_{t}").alias(f"orig_{t}") for t in targets])
    # all of a sample's donations meet its window once
    given = donor_keys(win, features, key, seed).join(
        _values(win, features, key), ["feature", *[f"_d_{k}" for k in key]])
    gifts = given.groupBy(*key).agg(F.collect_list(F.struct("feature", "place", "vals")).alias("gifts"))
    pairs = once.join(gifts, key).select("x", *[f"orig_{t}" for t in targets], F.inline("gifts"))
    scored = model.transform(pairs.withColumn("features", array_to_vector(_swapped(len(features)))))
    delta = sum(F.abs(F.col(f"pred_{t}") - F.col(f"orig_{t}")) for t in targets) / len(targets)
    per = scored.groupBy("feature").agg(F.avg(delta).alias("_d"))   # one row per feature
    return per.select(F.col("feature").alias("Variable"),
                      float_div("_d", F.sum("_d").over(Window.partitionBy())).alias("Importancia"))
