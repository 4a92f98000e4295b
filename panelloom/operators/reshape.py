"""Wide and long forms of a panel."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from panelloom.schema import KEY, TIME


#: cells of an attribute that a task holds at once when it turns columns into rows
CELLS_AT_ONCE = 1 << 20


def wide_to_long(df, attributes, entities, time=TIME, key=KEY, sep="|"):
    """Columns named ``attribute|entity`` to one row per (time, entity) with the attributes as columns.

    The columns of a batch are laid end to end, block by block, so nothing is shuffled and the plan
    holds one step whatever the number of entities. An attribute whose columns differ in type
    becomes a double. A missing column is an error.
    """
    names = {a: [f"{a}{sep}{e}" for e in entities] for a in attributes}
    have = {f.name: f for f in df.schema.fields}
    missing = [c for own in names.values() for c in own if c not in have]
    if missing:
        raise ValueError(f"no columns {missing[:5]}")
    kinds = {a: {have[c].dataType.simpleString() for c in own} for a, own in names.items()}
    schema = StructType([StructField(time, have[time].dataType), StructField(key, StringType())] + [
        StructField(a, have[own[0]].dataType if len(kinds[a]) == 1 else DoubleType()) for a, own in names.items()])
    wanted = [time, *[c for own in names.values() for c in own]]
    if len(wanted) < len(df.columns):
        df = df.select(*[F.col(f"`{c}`") for c in wanted])
    at = {c: i for i, c in enumerate(df.columns)}
    places = {a: [at[c] for c in own] for a, own in names.items()}
    mixed = {a for a in names if len(kinds[a]) > 1}
    own_keys, when = [str(e) for e in entities], at[time]

    def turned(batches):
        import pyarrow as pa
        labels = pa.array(own_keys, pa.string())
        for batch in batches:
            step = max(1, CELLS_AT_ONCE // max(1, len(own_keys)))
            for first in range(0, batch.num_rows, step):
                some = batch.slice(first, step)
                n = some.num_rows
                # entity after entity: a column is copied whole
                times = some.column(when).take(pa.array(list(range(n)) * len(own_keys), pa.int32()))
                keys = labels.take(pa.array([k for k in range(len(own_keys)) for _ in range(n)], pa.int32()))
                columns = [pa.concat_arrays([some.column(i).cast(pa.float64()) if a in mixed else some.column(i) for i in where])
                           for a, where in places.items()]
                yield pa.RecordBatch.from_arrays([times, keys, *columns], [time, key, *places])

    if not own_keys:
        return df.sparkSession.createDataFrame([], schema)
    return df.mapInArrow(turned, schema)


def single_to_long(df, entity, key=KEY):
    return df.withColumn(key, F.lit(entity))


def _only(value):
    """The value of a cell; a second one is an error, not a choice."""
    return F.when(F.count(value) <= 1, F.max(value)).otherwise(
        F.raise_error(F.lit("a cell has more than one value")))


def long_to_wide(df, entities, value, time=TIME, key=KEY):
    """A (time x entity) matrix of one value for a short list of entities."""
    return df.filter(F.col(key).isin(list(entities))).groupBy(time).pivot(key, list(entities)).agg(_only(value))


def dense_grid(panel, extra=None, time=TIME, key=KEY):
    """Every entity at every month known to the panel or to ``extra``; absent cells are null.

    The result has months x entities rows by definition, so no job here is built on it. The
    months arrive as one array from a scalar subquery and are exploded per entity.
    """
    months = panel.select(time)
    if extra is not None:
        months = months.union(extra.select(time))
    calendar = months.distinct().agg(F.sort_array(F.collect_list(time))).scalar()
    grid = panel.select(key).distinct().select(key, F.explode(calendar).alias(time))
    return grid.join(panel, [key, time], "left")


def transpose_statement(df, items, ids, item="Item", value="Value", aliases=None):
    """Line items in rows to one column per known item; other items are left out."""
    if aliases:
        pairs = [F.lit(x) for pair in aliases.items() for x in pair]
        name = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(item)), F.col(item))
        df = df.withColumn(item, name)
    return df.filter(F.col(item).isin(list(items))).groupBy(*ids).pivot(item, list(items)).agg(_only(value))


def strip_column_spaces(df):
    return df.toDF(*[c.replace(" ", "") for c in df.columns])
