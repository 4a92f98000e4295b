"""Imputation from group medians."""

from pyspark.sql import functions as F

from panelloom.operators.quantiles import ACCURACY, group_quantiles
from panelloom.session import lookup_join, stage


def group_medians(df, values, group, accuracy=ACCURACY):
    """Medians of several expressions (name -> Column) per group and over all rows, in one pass.

    Returns the staged table (``__group``, names) and the dict of overall medians. Every value
    counts once for its group and once for the whole. Groups are numbered by their text behind a
    mark, the whole is the unmarked empty text.
    """
    both = df.select(F.explode(F.array(_name(group), F.lit(""))).alias("__group"), *[v.alias(n) for n, v in values.items()])
    found = group_quantiles(both, list(values), [0.5], ["__group"], accuracy)
    table = stage(found.select("__group", *[F.col(n)[0].alias(n) for n in values]))
    overall = table.filter("__group = ''").first()
    return table, {n: overall and overall[n] for n in values}


def _name(group):
    return F.concat(F.lit("g"), F.col(group).cast("string"))


def with_medians(df, medians, group):
    """``df`` with the columns of ``group_medians``: the group's median, else that of all rows."""
    table, overall = medians
    out = lookup_join(df.withColumn("__group", _name(group)), table, ["__group"], ready=True).drop("__group")
    return out.withColumns({n: F.coalesce(n, F.lit(v).cast("double")) for n, v in overall.items()})


def _joined(df, value_expr, group, accuracy):
    return with_medians(df, group_medians(df, {"__median": value_expr}, group, accuracy), group)


def group_median_impute(df, col, group, accuracy=ACCURACY):
    """Null to the group's median, else to the median of the whole column.

    Like its siblings below it reads two or three columns of ``df`` a few times: a costly
    input should be staged first, projections and small joins over a staged one need not.
    """
    joined = _joined(df, F.col(col), group, accuracy)
    return joined.select([
        F.coalesce(F.col(c), F.col("__median")).alias(c) if c == col else F.col(c) for c in df.columns])


def _ratio(col, denominator):
    return F.when(F.col(denominator) > 0, F.col(col) / F.col(denominator))


def group_ratio_impute(df, col, group, denominator, accuracy=ACCURACY):
    """Null to (median of col/denominator in the group) x own denominator.

    Only positive denominators enter the median, any sign is projected. What is still null
    (no denominator) takes the group's, else the overall, median of the filled column.
    """
    joined = _joined(df, _ratio(col, denominator), group, accuracy)
    return _projected(joined, df.columns, col, group, denominator, "__median", accuracy)


def _projected(joined, columns, col, group, denominator, median, accuracy):
    """The second half of ``group_ratio_impute``; further columns of ``joined`` in ``columns`` are kept."""
    filled = stage(joined.select([
        F.coalesce(F.col(c), F.col(median) * F.col(denominator)).alias(c) if c == col else F.col(c)
        for c in columns]))
    return group_median_impute(filled, col, group, accuracy)


def current_assets_by_group(df, group="Sector", assets="CurrentAssets", total="TotalAssets", accuracy=ACCURACY):
    """Null current assets to total assets x the group's median ratio (zero totals have no ratio)."""
    joined = _joined(df, F.try_divide(assets, total), group, accuracy)
    return _by_ratio(joined, df.columns, assets, total, "__median")


def _by_ratio(joined, columns, assets, total, median):
    return joined.select([
        F.coalesce(F.col(c), F.col(total) * F.col(median)).alias(c) if c == assets else F.col(c)
        for c in columns])


def statement_ratios(df, col, denominator, between=(), group="Sector", assets="CurrentAssets", total="TotalAssets", accuracy=ACCURACY):
    """``group_ratio_impute`` of ``col``, the projections ``between``, then ``current_assets_by_group``.

    Both ratios are taken from ``df``, in one pass; ``between`` must leave ``assets`` and ``total`` as they are.
    """
    ratios = group_medians(df, {"__first": _ratio(col, denominator), "__second": F.try_divide(assets, total)}, group, accuracy)
    out = _projected(with_medians(df, ratios, group), [*df.columns, "__second"], col, group, denominator, "__first", accuracy)
    for step in between:
        out = step(out)
    return _by_ratio(out, [c for c in out.columns if c != "__second"], assets, total, "__second")
