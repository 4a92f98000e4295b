"""Near-duplicate embeddings by lattice hashing.

Unit vectors are projected by a random rotation onto ``BLOCKS`` blocks of eight dimensions, shifted
and scaled, and every block is decoded to the nearest point of the E8 lattice: the points of all blocks
are a cell. ``TABLES`` rotations give a vector as many home cells. Beside each, the ``PROBES`` cells are
probed that one block's step to a neighbouring lattice point reaches at the least cost. Vectors of
equal label that share a cell are compared by their cosine in double precision.

Recall: two vectors of cosine 0.93 share a cell of one table with probability 0.45, hence any of
twelve with 0.999 (measured on random pairs); closer ones with more. Nothing below the threshold is
linked.

Links are counted, not listed. A pair that shares several cells counts in the least of them, which
both vectors' own lists of cells tell, so no pair is written down. Equal vectors are one node with a
count. Groups of near copies of any size are taken whole: a home cell of ``DENSE`` or more vectors
offers the mean of a few of its vectors as a centre, centres in common cells agree on the one of the
largest cell, and vectors within half the threshold's angle of their centre are a ball, all of whose
members are linked with each other by the triangle inequality. Only pairs that do not lie in one ball
are compared. In a cell with more than ``CHUNK`` vectors the work is dealt out by pairs of chunks.

Cases: vectors that are null, empty, zero or hold null or non-finite entries, and rows without a
label, link with nothing and are their own component. Vectors of different lengths never link.
Repeated rows are linked copies. A component's id is its least identifier; nulls are passed over,
so a null identifier is the id only where there is no other. Other columns are not read, so no
name can clash. An empty table gives an empty result.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelloom.llm.common import map_batches, slices, staged
from panelloom.llm.components import components

COSINE = 0.93
TABLES, BLOCKS, PROBES = 12, 3, 5
#: edge of the lattice, for blocks of which all together have norm one
WIDTH = 0.45
#: vectors in a home cell that offers a centre, and how many of them it is the mean of
DENSE, CENTRE_OF = 64, 32
CHUNK = 2048
MARGIN = 1e-9


def neighbours():
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if np.prod(s) > 0]
    return np.array(out)


def nearest_even(x):
    """Nearest whole points with an even sum: the coordinate rounded worst goes the other way if need be."""
    r = np.rint(x)
    error = x - r
    worst = np.abs(error).argmax(axis=-1)[..., None]
    step = np.where(np.take_along_axis(error, worst, -1) < 0, -1.0, 1.0)
    odd = (r.sum(axis=-1) % 2 != 0)[..., None]
    np.put_along_axis(r, worst, np.take_along_axis(r, worst, -1) + step * odd, -1)
    return r


def nearest_lattice(x):
    """Nearest points of E8: of the even points and those shifted by one half."""
    a, b = nearest_even(x), nearest_even(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=-1) <= ((x - b) ** 2).sum(axis=-1)
    return np.where(closer[..., None], a, b)


class Lattice:
    """Rotations, shifts and hash multipliers of all tables for vectors of one length."""

    def __init__(self, d, seed=13):
        rng = np.random.default_rng(seed)
        wide = 8 * BLOCKS
        self.pad = max(d, wide)
        self.around = neighbours()
        self.turns, self.shifts, self.multipliers = [], [], []
        for _ in range(TABLES):
            q, _ = np.linalg.qr(rng.standard_normal((self.pad, wide)))
            self.turns.append(q * np.sqrt(self.pad / wide) / WIDTH)
            self.shifts.append(rng.random((BLOCKS, 8)) * 2)
            self.multipliers.append(rng.integers(1, 1 << 62, size=(BLOCKS, 8)) | 1)
        self.salts = rng.integers(1, 1 << 62, size=TABLES)

    def cells(self, units, group):
        """(home cells, probed cells) as 64-bit hashes that depend on the group too."""
        n = len(units)
        if self.pad > units.shape[1]:
            units = np.pad(units, ((0, 0), (0, self.pad - units.shape[1])))
        homes, probes = np.empty((n, TABLES), np.int64), np.empty((n, TABLES, PROBES), np.int64)
        for t, (turn, shift, mult) in enumerate(zip(self.turns, self.shifts, self.multipliers)):
            x = (units @ turn).reshape(n, BLOCKS, 8) + shift
            point = nearest_lattice(x)
            gain = ((x - point) @ self.around.T).reshape(n, -1)
            best = np.argpartition(gain, -PROBES, axis=1)[:, -PROBES:]
            # points count in halves; a step changes the sum by the step's own
            home = ((2 * point).astype(np.int64) * mult).sum(axis=(1, 2)) + self.salts[t]
            steps = ((2 * self.around).astype(np.int64)[None] * mult[:, None, :]).sum(axis=-1).reshape(-1)
            homes[:, t] = home
            probes[:, t] = home[:, None] + steps[best]
        return _mixed(homes, group[:, None]), _mixed(probes, group[:, None, None]).reshape(n, -1)


def _mixed(cells, group):
    with np.errstate(over="ignore"):
        x = cells.view(np.uint64) ^ (np.broadcast_to(group, cells.shape).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (x ^ (x >> np.uint64(29))).view(np.int64)


_LATTICES = {}


def _lattice(d):
    if d not in _LATTICES:
        _LATTICES[d] = Lattice(d)
    return _LATTICES[d]


def units_of(flat, d):
    """Unit vectors in double precision; scaled by the largest entry first, so no square overflows."""
    v = np.asarray(flat, np.float64).reshape(-1, d)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _by_length(column):
    """(positions, unit vectors) of the rows of each length of an Arrow list column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == d)
        part = column if len(at) == len(lengths) else column.take(pa.array(at))
        yield at, units_of(part.flatten().to_numpy(zero_copy_only=False), d)


def _lists(matrix, kind=None):
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(matrix.reshape(-1), kind))


def _signed(batches):
    """Adds ``homes`` and ``cells`` (all of a vector's cells, ascending) from ``g`` and the last column."""
    for batch in slices(batches, rows=1024):
        n = batch.num_rows
        group = batch.column(batch.schema.get_field_index("g")).to_numpy(zero_copy_only=False)
        homes, cells = np.empty((n, TABLES), np.int64), np.empty((n, TABLES * (1 + PROBES)), np.int64)
        for at, units in _by_length(batch.column(n_last := batch.num_columns - 1)):
            own, probed = _lattice(units.shape[1]).cells(units, group[at])
            homes[at], cells[at] = own, np.sort(np.concatenate([own, probed], axis=1), axis=1)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:n_last], batch.column(n_last), _lists(homes), _lists(cells)],
            [*batch.schema.names, "homes", "cells"])


# ---- balls ------------------------------------------------------------------------------------


def _centres(batches):
    """(g, cell, n, centre, homes of the centre) from (g, cell, n, list of vectors)."""
    for batch in slices(batches, rows=64):
        out = []
        for g, cell, n, some in zip(*[c.to_pylist() for c in batch.columns]):
            mean = units_of(np.array(some, np.float64).reshape(-1), len(some[0])).mean(axis=0)
            size = np.sqrt((mean * mean).sum())
            if size > 0.5:  # vectors all around have no centre
                mean = mean / size
                homes, _ = _lattice(len(mean)).cells(mean[None], np.array([g]))
                out.append((g, cell, n, mean.tolist(), homes[0].tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], kind) for i, kind in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64())))],
            ["g", "cell", "n", "centre", "homes"])


def _inside(batches, least):
    """(rep, ball) of the vectors whose cosine with their centre is at least ``least``."""
    for batch in slices(batches, rows=4096):
        rep, ball = batch.column(0), batch.column(1)
        keep = np.zeros(batch.num_rows, bool)
        lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        for at, units in _by_length(batch.column(2)):
            centre = batch.column(3).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), lengths[at[0]])
            keep[at] = (units * centre).sum(axis=1) >= least
        mask = pa.array(keep)
        yield pa.RecordBatch.from_arrays([rep.filter(mask), ball.filter(mask)], ["rep", "ball"])


def balls(signed, cosine=COSINE):
    """(rep, ball) of the vectors that lie within half the angle around a common centre."""
    homes = signed.select("rep", "g", F.explode("homes").alias("cell"))
    dense = staged(homes.groupBy("g", "cell").agg(F.count("*").alias("n")).filter(F.col("n") >= DENSE))
    if dense.isEmpty():
        return None
    chosen = homes.join(dense, ["g", "cell"]).withColumn(
        "r", F.row_number().over(Window.partitionBy("g", "cell").orderBy(F.xxhash64("rep"), "rep"))).filter(F.col("r") <= CENTRE_OF)
    some = chosen.select("rep", "g", "cell", "n").join(signed.select("rep", "v"), "rep").groupBy("g", "cell", "n").agg(
        F.collect_list("v").alias("some"))
    centres = staged(map_batches(some, _centres, "g long, cell long, n long, centre array<double>, homes array<long>"))
    # every centre follows the one of the largest cell among those it would itself be hashed to
    near = centres.select("g", F.col("cell").alias("own"), F.col("n").alias("own_n"), F.explode("homes").alias("cell"))
    known = centres.select("g", "cell", "n")
    lead = staged(near.join(known, ["g", "cell"], "left").groupBy("g", "own", "own_n").agg(F.max(F.struct("n", "cell")).alias("x"))
                  .select("g", F.col("own").alias("cell"), F.when(F.col("x.n") > F.col("own_n"), F.col("x.cell")).otherwise(F.col("own")).alias("root")))
    for _ in range(3):
        step = lead.select("g", F.col("cell").alias("root"), F.col("root").alias("further"))
        lead = staged(lead.join(step, ["g", "root"], "left").select("g", "cell", F.coalesce("further", "root").alias("root")))
    roots = lead.join(known.select("g", F.col("cell").alias("root"), "n"), ["g", "root"])
    wanted = homes.join(roots, ["g", "cell"]).groupBy("rep", "g").agg(F.max(F.struct("n", "root")).alias("x")).select(
        "rep", "g", F.col("x.root").alias("ball"))
    tested = wanted.join(signed.select("rep", "v"), "rep").join(
        centres.select("g", F.col("cell").alias("ball"), "centre"), ["g", "ball"]).select("rep", "ball", "v", "centre")
    least = float(np.cos(np.arccos(cosine) / 2)) + MARGIN
    return staged(map_batches(tested, lambda it: _inside(it, least), "rep long, ball long"))


# ---- comparison -------------------------------------------------------------------------------


def _first_common(a, b):
    """Least common value of the rows of two matrices with ascending rows; a row without one gives the largest long."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    same = both[:, 1:] == both[:, :-1]
    at = same.argmax(axis=1)
    rows = np.arange(len(both))
    return np.where(same[rows, at], both[rows, at], np.iinfo(np.int64).max)


def _smallest_reached(n, a, b):
    """Per node the least node reachable by the links (a, b)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(rep, copies, ball, role, cell, units, cells, cosine):
    """(rep, added links, representative of the piece) of one piece of work."""
    left, right = np.flatnonzero(role != 1), np.flatnonzero(role != 0)
    if not len(left) or not len(right):  # a chunk that no vector was dealt to
        return None
    found_a, found_b = [], []
    for at in range(0, len(left), 512):
        some = left[at:at + 512]
        high = units[some] @ units[right].T >= cosine
        i, j = np.nonzero(high)
        i, j = some[i], right[j]
        # a role of 2 meets its own kind: one order of the two is enough
        good = ((role[i] != 2) | (i < j)) & ((ball[i] != ball[j]) | (ball[i] == 0))
        found_a.append(i[good])
        found_b.append(j[good])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    if len(a):
        mine = np.concatenate([_first_common(cells[a[k:k + 8192]], cells[b[k:k + 8192]]) == cell
                               for k in range(0, len(a), 8192)])
        a, b = a[mine], b[mine]
    if not len(a):
        return None
    added = np.bincount(a, copies[b], len(rep)) + np.bincount(b, copies[a], len(rep))
    label = _smallest_reached(len(rep), a, b)
    some = np.flatnonzero(added > 0)
    return rep[some], np.rint(added[some]).astype(np.int64), rep[label[some]]


COLUMNS = ("cell", "g", "i", "j", "role", "rep", "copies", "ball", "v", "cells")


def _linked(batches, cosine):
    """Links found in the pieces (cell, g, i, j), which arrive one after the other."""
    held = []

    def settle(table):
        cell, g, i, j, role, rep, copies, ball = (table.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in COLUMNS[:8])
        vectors, lists = table.column("v").combine_chunks(), table.column("cells").combine_chunks()
        cells = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(rep), -1)
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(lengths) - lengths
        new = (cell[1:] != cell[:-1]) | (g[1:] != g[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(rep)]
        out = []
        for x, y in zip(cuts, cuts[1:]):
            if y - x > 1:
                units = units_of(flat[starts[x]:starts[x] + (y - x) * lengths[x]], lengths[x])
                got = _compare(rep[x:y], copies[x:y], ball[x:y], role[x:y], cell[x], units, cells[x:y], cosine)
                if got:
                    out.append(got)
        return out

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out]) if out else [], pa.int64()) for k in range(3)],
                                          ["rep", "added", "other"])

    def piece(table, row):
        return tuple(table.column(k)[row].as_py() for k in ("cell", "g", "i", "j"))

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held and piece(held[0], 0) != piece(table, 0):
            yield batch_of(settle(pa.concat_tables(held)))
            held = []
        # the last piece may go on in the next batch
        keys = [table.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in ("cell", "g", "i", "j")]
        differs = np.zeros(table.num_rows, bool)
        for k in keys:
            differs |= k != k[-1]
        cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        if cut:
            yield batch_of(settle(pa.concat_tables([*held, table.slice(0, cut)])))
            held = []
        held.append(table.slice(cut))
    if held:
        yield batch_of(settle(pa.concat_tables(held)))


def _work(members, chunk=CHUNK):
    """The pieces (cell, g, i, j) with their rows: the vectors outside a cell's largest ball against all.

    Chunk i of these meets every later chunk of its own kind (j >= i) and every chunk of the ball (j < 0).
    Members of the ball never meet each other.
    """
    entries = members.select("rep", "g", "ball", F.explode("cells").alias("cell"))
    sizes = entries.groupBy("g", "cell", "ball").agg(F.count("*").alias("c")).groupBy("g", "cell").agg(
        F.sum("c").alias("n"), F.max(F.when(F.col("ball") != 0, F.struct("c", "ball"))).alias("x"))
    plan = sizes.select("g", "cell", F.coalesce("x.ball", F.lit(0)).alias("main"), F.coalesce("x.c", F.lit(0)).alias("m"), "n")
    plan = plan.filter((F.col("n") > 1) & (F.col("n") > F.col("m"))).select(
        "g", "cell", "main", F.ceil(F.col("m") / chunk).cast("int").alias("qm"), F.ceil((F.col("n") - F.col("m")) / chunk).cast("int").alias("qs"))
    rows = entries.join(plan, ["g", "cell"])
    main = (F.col("ball") != 0) & (F.col("ball") == F.col("main"))
    part = F.pmod(F.xxhash64("rep", "cell"), F.greatest(F.when(main, F.col("qm")).otherwise(F.col("qs")), F.lit(1)).cast("long")).cast("int")
    rows = rows.withColumns({"main": main, "part": part})
    # (i, j, role): the roles are left 0, right 1, and 2 where a chunk meets itself
    pieces = F.expr("""
        if(main, transform(sequence(0, qs - 1), i -> struct(i as i, -1 - part as j, 1 as role)),
           concat(if(qm > 0, transform(sequence(0, qm - 1), j -> struct(part as i, -1 - j as j, 0 as role)), array()),
                  transform(sequence(part, qs - 1), j -> struct(part as i, j as j, if(j = part, 2, 0) as role)),
                  if(part > 0, transform(sequence(0, part - 1), i -> struct(i as i, part as j, 1 as role)), array())))""")
    return rows.select("rep", "g", "cell", F.explode(pieces).alias("x")).select("rep", "g", "cell", "x.i", "x.j", "x.role")


def near_duplicates(df, vector="embedding", label="label", vec_id="vec_id", cosine=COSINE, chunk=CHUNK):
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` per row of ``df``."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = v.isNotNull() & F.col(f"`{label}`").isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda c: c != 0)
    own = F.col(f"`{label}`")
    rows = staged(df.select(
        F.col(f"`{vec_id}`").alias("id"), F.coalesce(good, F.lit(False)).alias("good"), v.alias("v"), F.xxhash64(own, F.size(v)).alias("g"),
        F.xxhash64(v, own).alias("h1"), F.xxhash64(F.lit("second"), own, v).alias("h2")))
    # equal vectors of a label are one node; 128 bits of hash name it
    reps = staged(rows.filter("good").groupBy("h1", "h2").agg(
        F.first("v").alias("v"), F.first("g").alias("g"), F.min("id").alias("least"), F.count("*").alias("copies")).withColumn(
        "rep", F.monotonically_increasing_id()))
    kind = df.schema[vector].dataType.simpleString()
    signed = staged(map_batches(reps.select("rep", "copies", "g", "v"), _signed,
                                f"rep long, copies long, g long, v {kind}, homes array<long>, cells array<long>"))
    found = balls(signed, cosine)
    if found is None:
        members = signed.withColumn("ball", F.lit(0).cast("long"))
    else:
        members = staged(signed.join(found, "rep", "left").withColumn("ball", F.coalesce("ball", F.lit(0).cast("long"))).drop("homes"))
    work = _work(members, chunk).join(members.select("rep", "copies", "ball", "v", "cells"), "rep").select(*COLUMNS)
    dealt = work.repartition("cell", "g", "i", "j").sortWithinPartitions("cell", "g", "i", "j")
    links = staged(map_batches(dealt, lambda it: _linked(it, cosine), "rep long, added long, other long"))
    in_ball = members.filter("ball != 0").select("rep", "ball", "copies")
    of_ball = staged(in_ball.groupBy("ball").agg(F.sum("copies").alias("all"), F.min("rep").alias("head")))
    stars = in_ball.join(of_ball, "ball").select("rep", F.col("head").alias("other"), (F.col("all") - F.col("copies")).alias("added"))
    both = links.select("rep", "other", "added").unionAll(stars)
    added = both.groupBy("rep").agg(F.sum("added").alias("added"))
    groups = staged(components(both.select(F.col("rep").alias("a"), F.col("other").alias("b"))))
    nodes = reps.select("h1", "h2", "rep", "least", "copies").join(added, "rep", "left").join(
        groups.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = staged(nodes.join(least, "component").select(
        "h1", "h2", (F.coalesce("added", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    out = rows.select("id", *[F.when(F.col("good"), F.col(h)).alias(h) for h in ("h1", "h2")]).join(nodes, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
