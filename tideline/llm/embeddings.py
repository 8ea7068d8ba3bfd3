"""Embedding near-dedup: spherical k-means cells, border visits, blocked cosine products.

Vectors are compared when their labels are equal and not null and the cosine,
in double precision, is at least the threshold.  Vectors that are null, zero or
hold null or non-finite components link with nothing; so do vectors of
different lengths.

1. Equal vectors of a label are one node with a count (pre-aggregated).
2. A node's code holds its coordinates on up to ``AXES`` orthogonal axes and the
   length of the rest.  It is a unit vector, too, and two codes are no farther
   apart than their vectors.  Spherical k-means on a bounded sample of codes
   gives the cells.  A node's home is its nearest centroid.
3. A node also visits every other cell whose border is near enough: if x has
   home c and cos(x, y) >= t, then |x - y| <= sqrt(2 - 2 t), so y is at most
   that far beyond the plane between its own home and c.  The visit test is
   this bound, so no pair is lost at a border.
4. Visits are made by codes alone.  The cells of a label are cut into parts of a
   bounded number of nodes; a code goes once to each part that it visits (of two
   parts, to one), and there meets the codes whose cell it visits and that visit
   its own.  What comes out are the nodes whose code is near enough to another's,
   and the cells of those others.
5. Only these nodes' vectors are moved: to their home and to those cells.  A cell
   of one label is cut into blocks of a bounded number of vectors, and every
   block meets every block in a matrix product of its home vectors with all
   vectors there.  A pair of blocks gives the number of partners of each home
   vector and a spanning set of links, not the pairs.
6. Components of the links; of each, the smallest vec_id is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import bloom, maybe_in, staged
from tideline.llm.components import components

SAMPLE = 8192  # directions that the axes and centroids are fitted on
CELL_VECTORS = 4096  # vectors in a cell, on average
MAX_CELLS = 4096
TURNS = 12
AXES = 24  # coordinates of a code
ROUGH = 15  # of these, compared first
STEP = 1 << 14  # steps of a code between 0 and 1
SLACK = 1e-3  # more than rounding to steps takes from the cosine of two codes
PART = 1 << 18  # codes of a part, on average
BLOCK = 1 << 17  # vectors of a block, on average
FEW = 1 << 15  # cells and labels of fewer rows share a task
HALL, HALLS = 1024, 4  # codes of a cell in a product, on average; cells that make one of the next size
ROWS, COLUMNS = 512, 4096  # of a product
BATCH = 8192  # rows of an Arrow batch


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spherical_kmeans(sample: np.ndarray, cells: int, seed: int = 5) -> np.ndarray:
    """Unit centroids: nearest by cosine, then the direction of the sum."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(TURNS):
        home = np.concatenate([(sample[i : i + ROWS] @ centroids.T).argmax(axis=1) for i in range(0, len(sample), ROWS)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, sample)
        size = np.linalg.norm(sums, axis=1)
        centroids = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centroids)
    return centroids


@dataclass
class Frame:
    """Of the vectors of one length: the axes and the cells' centroids."""

    axes: np.ndarray
    centroids: np.ndarray
    halls: tuple = ()  # centroids of fewer and fewer, larger cells


    def codes(self, x: np.ndarray) -> np.ndarray:
        """Codes of unit vectors, in steps."""
        y = x @ self.axes
        rest = np.sqrt(np.maximum(0, 1 - (y**2).sum(axis=1)))
        return np.rint(STEP * np.column_stack([y, rest])).astype(np.int16)

    def home(self, codes: np.ndarray) -> np.ndarray:
        return nearest(self.centroids, codes)

    def rooms(self, home: np.ndarray) -> np.ndarray:
        """Centroids of cells that hold enough of these codes for a product."""
        few = HALL * len(np.unique(home)) / max(1, len(home))  # cells of this many would do
        return next((c for c in self.halls if len(self.centroids) <= HALLS * few * len(c)), self.centroids) if few >= HALLS else self.centroids


def nearest(centroids: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype=np.int64), *((floats(codes[i : i + ROWS]) @ centroids.T).argmax(axis=1) for i in range(0, len(codes), ROWS))])


def margins(centroids: np.ndarray, far: float) -> np.ndarray:
    """How much nearer to its home (rows) than to another cell (columns) a code is
    at most that is ``far`` or less from the plane between."""
    out = np.empty((len(centroids), len(centroids)), dtype=np.float32)
    for i in range(0, len(out), ROWS):
        own = centroids[i : i + ROWS]
        apart = (own**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1)[None, :] - 2 * (own @ centroids.T)
        out[i : i + ROWS] = far * np.sqrt(np.maximum(0, apart)) + 1e-5
    return out


def visits(centroids: np.ndarray, codes: np.ndarray, home: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Which of the cells (columns) may hold a code near to these."""
    near = codes @ centroids.T
    near += margin[home]
    return near >= (codes * centroids[home]).sum(axis=1)[:, None] - np.float32(1e-6)


def floats(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float32) / np.float32(STEP)


def rough(codes: np.ndarray) -> np.ndarray:
    """The first coordinates and the length of the rest: a code of fewer axes."""
    if codes.shape[1] <= ROUGH + 1:
        return codes
    y = codes[:, :ROUGH]
    return np.column_stack([y, np.sqrt((codes[:, ROUGH:] ** 2).sum(axis=1))])


def reach(threshold: float) -> float:
    """How far apart the codes of two linked vectors are at most."""
    return float(np.sqrt(max(0.0, 2 - 2 * (threshold - SLACK))))


def _in_order(centroids: np.ndarray) -> np.ndarray:
    """The centroids so that near ones are close in order: halved again and again
    along their longest axis."""
    if len(centroids) < 3:
        return centroids
    y = centroids - centroids.mean(axis=0)
    order = np.argsort(y @ np.linalg.eigh(y.T @ y)[1][:, -1], kind="stable")
    half = len(order) // 2
    return np.concatenate([_in_order(centroids[order[:half]]), _in_order(centroids[order[half:]])])


def plain_frame(dim: int) -> Frame:
    k = min(dim, AXES)
    return Frame(np.eye(dim, k), np.zeros((1, k + 1), dtype=np.float32))


def fit(sample: np.ndarray, cells: int) -> Frame:
    """Axes along which the unit vectors of the sample differ most, cells of their codes."""
    frame = plain_frame(sample.shape[1])
    if cells <= 1:
        return frame
    y = sample - sample.mean(axis=0)
    frame.axes = np.ascontiguousarray(np.linalg.eigh(y.T @ y)[1][:, ::-1][:, : frame.axes.shape[1]])
    codes = unit(frame.codes(sample) / STEP)
    frame.centroids = _in_order(spherical_kmeans(codes, cells)).astype(np.float32)
    while (fewer := cells // HALLS ** (len(frame.halls) + 1)) > 1:
        frame.halls += (spherical_kmeans(codes, fewer).astype(np.float32),)
    return frame


def _scaled(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each length: the numbers of the sound rows, their vectors as they are
    and in doubles, scaled by the largest component, so that neither squares nor
    copies at another scale matter."""
    column = part.column("embedding")
    values, starts = column.values, column.offsets.to_numpy()
    raw = (pc.fill_null(values, np.nan) if values.null_count else values).to_numpy(zero_copy_only=False)
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(starts), 0)
    labelled = part.column("label").is_valid().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes[labelled & (sizes > 0)]).tolist():
        rows = np.flatnonzero(labelled & (sizes == dim))
        own = raw[starts[rows][:, None] + np.arange(dim)]
        x = own.astype(np.float64)
        most = np.abs(x).max(axis=1)
        sound = np.isfinite(x).all(axis=1) & (most > 0)
        if sound.any():
            yield rows[sound], own[sound], x[sound] / most[sound, None] + 0.0


def _coded(frames: dict[int, Frame], with_code: bool):
    """(vec_id, label, dim, key, cell, data) of each row: ``key`` are the bytes of
    the scaled vector, ``data`` those of its code or of the vector as it is."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            n = part.num_rows
            dims, cells, keys, data = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32), [None] * n, [None] * n
            for rows, own, x in _scaled(part):
                dim = x.shape[1]
                dims[rows] = dim
                if with_code:
                    frame = frames.get(dim) or plain_frame(dim)
                    own = frame.codes(unit(x))
                    cells[rows] = frame.home(own)
                for i, k, d in zip(rows.tolist(), x, own):
                    keys[i], data[i] = k.tobytes(), d.tobytes()
            kinds = {"dim": pa.array(dims), "key": pa.array(keys, pa.binary()), "cell": pa.array(cells), "data": pa.array(data, pa.binary())}
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), *kinds.values()], names=["vec_id", "label", *kinds])

    return run


def _part(cell: np.ndarray, parts: int, cells: int) -> np.ndarray:
    """The part of a label that holds a cell: parts are runs of cells."""
    return cell.astype(np.int64) * parts // cells


def _places(frames: dict[int, Frame], cells: int, threshold: float):
    """(node, dim, label, cell, part, home, code) of the parts that a code is at
    home in or visits.  Of two parts one has the other's visits: that from which
    fewer steps lead round to the other."""
    far = reach(threshold)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin: dict[int, np.ndarray] = {}
        for part in parts:
            dims, count = part.column("dim").to_numpy(), part.column("parts").to_numpy()
            home = part.column("cell").to_numpy().astype(np.int64)
            own = _part(home, count, cells)
            at, to = [np.arange(part.num_rows)], [own]
            for dim, n in {*zip(dims.tolist(), count.tolist())}:
                frame = frames.get(dim)
                if n == 1 or frame is None:
                    continue
                rows = np.flatnonzero((dims == dim) & (count == n))
                codes = _matrix(part.column("code"), rows, np.int16)
                every = np.arange(len(frame.centroids))
                of = _part(every, n, cells)
                first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
                if dim not in margin:
                    margin[dim] = margins(frame.centroids, far)
                for i in range(0, len(rows), ROWS):
                    some = rows[i : i + ROWS]
                    seen = np.logical_or.reduceat(visits(frame.centroids, floats(codes[i : i + ROWS]), home[some], margin[dim]), first, axis=1)
                    r, k = np.nonzero(seen)
                    r, k = some[r], of[first][k]
                    steps = (k - own[r]) % n
                    go = (steps > 0) & ((2 * steps < n) | ((2 * steps == n) & (k < own[r])))
                    at.append(r[go])
                    to.append(k[go])
            at, to = np.concatenate(at), np.concatenate(to)
            taken = part.select(["node", "dim", "label", "cell", "code"]).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(to), pa.array(np.arange(len(at)) < part.num_rows)], names=["node", "dim", "label", "cell", "code", "part", "home"])

    return run


def _matrix(column: pa.Array, rows: np.ndarray, kind) -> np.ndarray:
    """Rows of a binary column, all of one length."""
    taken = pa.concat_arrays([column.take(pa.array(rows))])
    start, end = taken.offset, taken.offset + len(taken)
    offsets = np.frombuffer(taken.buffers()[1], dtype=np.int32)[start : end + 1]
    return np.frombuffer(taken.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].view(kind).reshape(len(rows), -1)


def _gathered(parts: Iterator[pa.RecordBatch], binary: str) -> tuple[dict[str, np.ndarray], Callable]:
    """The columns of all batches, and what gives rows of the ``binary`` one (all
    of one length) as a matrix.  A batch goes as the next one comes."""
    found: dict[str, list] = {}
    for part in parts:
        for name, column in zip(part.schema.names, part.columns):
            if name == binary:
                offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
                found.setdefault("__tl_bytes", []).append(np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].copy())
                found.setdefault("__tl_sizes", []).append(np.diff(offsets))
            elif name != "task":
                found.setdefault(name, []).append(column.to_numpy().copy())
    columns = {name: np.concatenate(found.pop(name)) for name in [*found]}
    data, sizes = columns.pop("__tl_bytes"), columns.pop("__tl_sizes")
    even = bool((sizes == sizes[0]).all())
    starts = None if even else np.cumsum(sizes) - sizes

    def matrix(rows: np.ndarray, kind: type) -> np.ndarray:
        if even:
            return data.view(kind).reshape(len(sizes), -1)[rows]
        wide = sizes[rows[0]] if len(rows) else 0
        return data[starts[rows][:, None] + np.arange(wide)].view(kind)

    return columns, matrix


def _runs(columns: dict[str, np.ndarray], keys: list[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """The rows of each value of the keys."""
    cols = [columns[k] for k in keys if (columns[k] != columns[k][0]).any()]
    order = np.lexsort(cols[::-1]) if cols else np.arange(len(columns[keys[0]]))
    new = np.zeros(len(order), dtype=bool)
    for c in cols:
        new[1:] |= c[order][1:] != c[order][:-1]
    for rows in np.split(order, np.flatnonzero(new)):
        yield tuple(int(columns[k][rows[0]]) for k in keys), rows


def _any(hit: np.ndarray, cells: np.ndarray, axis: int) -> tuple[np.ndarray, np.ndarray]:
    """Of hits whose rows or columns (``axis``) lie in these cells, in order: which
    of the others hit which cell."""
    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    some = np.nonzero(np.logical_or.reduceat(hit, first, axis=axis))
    return some[1 - axis], cells[first][some[axis]]


def near_codes(frame: Frame, threshold: float, codes: np.ndarray, home: np.ndarray, others: np.ndarray | None = None, other_home: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``codes``, cell) and (row of ``others``, cell): the cells that hold
    a code near enough to that row.  Without ``others``, ``codes`` meet each other.
    Of two cells, those codes meet that visit the other's cell both ways."""
    far, least, cells, rooms = reach(threshold), np.float32(threshold - SLACK), len(frame.centroids), frame.rooms(home)
    margin, same = margins(rooms, far), others is None

    def placed(codes: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, ...]:
        room = nearest(rooms, codes)
        order = np.lexsort((home, room))
        x = floats(codes[order])
        return x, rough(x), home[order], room[order], order, np.searchsorted(room[order], np.arange(len(rooms) + 1))

    a, a_rough, a_home, a_room, a_order, starts = placed(codes, home)
    b, b_rough, b_home, b_room, b_order, ends = (a, a_rough, a_home, a_room, a_order, starts) if same else placed(others, other_home)
    calls = np.empty((len(rooms), -(-len(a) // 8)), dtype=np.uint8)  # which of codes visit a room, in bits
    for i in range(0, len(a), ROWS):
        calls[:, i // 8 : (i + ROWS) // 8] = np.packbits(visits(rooms, a[i : i + ROWS], a_room[i : i + ROWS], margin), axis=0).T
    mine, theirs = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for room in np.flatnonzero(np.diff(ends)).tolist():
        callers = np.flatnonzero(np.unpackbits(calls[room], count=len(a)))
        bounds = np.searchsorted(callers, starts)
        for lo in range(ends[room], ends[room + 1], COLUMNS):
            hi = min(lo + COLUMNS, ends[room + 1])
            seen = np.empty((len(rooms), hi - lo), dtype=bool)
            for i in range(lo, hi, ROWS):
                to = min(i + ROWS, hi)
                seen[:, i - lo : to - lo] = visits(rooms, b[i:to], b_room[i:to], margin).T
            for other in range(room + 1 if same else len(rooms)):
                rows = callers[bounds[other] : bounds[other + 1]]
                cols = np.flatnonzero(seen[other]) if len(rows) else rows
                if not len(cols):
                    continue
                b_cols = b_rough.take(cols + lo, axis=0)
                for p in range(0, len(rows), ROWS):
                    some = rows[p : p + ROWS]
                    product = b_cols @ a_rough.take(some, axis=0).T
                    if product.max() < least:
                        continue
                    at = cols[product.max(axis=1) >= least] + lo
                    hit = b[at] @ a[some].T >= least
                    if same and other == room:
                        hit &= at[:, None] != some[None, :]
                    if hit.any():
                        r, cell = _any(hit, b_home[at], 0)
                        mine.append(a_order[some[r]] * cells + cell)
                        c, cell = _any(hit, a_home[some], 1)
                        theirs.append(b_order[at[c]] * cells + cell)
    x, y = np.unique(np.concatenate(mine)), np.unique(np.concatenate(theirs))
    return x // cells, x % cells, y // cells, y % cells


def _search(frames: dict[int, Frame], threshold: float):
    """(node, dim, label, cell, at): the cells ``at`` that hold a code near that of ``node``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, codes = _gathered(parts, "code")
        role, homes, nodes = columns["role"], columns["cell"], columns["node"]
        for (dim, label, _, _, _), rows in _runs(columns, ["dim", "label", "part", "s", "t"]):
            if len(rows) < 2:
                continue
            kind, frame = role[rows], frames.get(dim) or plain_frame(dim)
            home, others = rows[kind & 1 > 0], rows[kind == 2]
            x, found, cell = codes(home, np.int16), [], []
            for meet in ([None] if (kind == 3).any() else []) + ([others] if len(others) else []):
                pairs = near_codes(frame, threshold, x, homes[home], *(() if meet is None else (codes(meet, np.int16), homes[meet])))
                found += [home[pairs[0]], (home if meet is None else meet)[pairs[2]]]
                cell += [pairs[1], pairs[3]]
            if not found:
                continue
            found, cell = np.concatenate(found), np.concatenate(cell)
            cols = {"node": nodes[found], "dim": np.full(len(found), dim, dtype=np.int32), "label": np.full(len(found), label), "cell": homes[found], "at": cell.astype(np.int32)}
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in cols.values()], names=[*cols])

    return run


def _spanning(hit: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids that connect all that the linked ``(row, column)`` cells
    connect: every row and column takes the least label it is linked to, until
    none changes, and then points to the owner of its label."""
    none = np.int32(len(rows) + len(cols))
    at_row, at_col = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    hit = hit[np.ix_(at_row, at_col)]
    ids = np.concatenate([rows[at_row], cols[at_col]])
    row_label = np.arange(len(at_row), dtype=np.int32)
    col_label = np.arange(len(at_row), len(ids), dtype=np.int32)
    while True:
        new_col = np.minimum(col_label, np.where(hit, row_label[:, None], none).min(axis=0))
        new_row = np.minimum(row_label, np.where(hit, new_col[None, :], none).min(axis=1))
        if (new_row == row_label).all() and (new_col == col_label).all():
            break
        row_label, col_label = new_row, new_col
    owner = ids[np.concatenate([row_label, col_label])]
    apart = ids != owner
    return ids[apart], owner[apart]


def _compare(threshold: float, kind: type):
    """Of each ordered pair of blocks of a cell: (a, b, null) links that span,
    and (node, null, n): the vectors linked to a node that is at home here."""

    def units(rows: np.ndarray) -> np.ndarray:
        x = rows.astype(np.float64)
        return unit(x / np.abs(x).max(axis=1, keepdims=True))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, vectors = _gathered(parts, "vector")
        role, nodes, copies = columns["role"], columns["node"], columns["copies"]
        for _, rows in _runs(columns, ["dim", "label", "cell", "s", "t"]):
            home, other = rows[role[rows] & 1 > 0], rows[role[rows] & 2 > 0]
            if not len(home) or not len(other):
                continue
            a, b, partners = [], [], np.zeros(len(home), dtype=np.int64)
            x = units(vectors(home, kind))
            for lo in range(0, len(other), COLUMNS):
                cols = other[lo : lo + COLUMNS]
                y, ids, weights = units(vectors(cols, kind)), nodes[cols], copies[cols].astype(np.float64)
                for p in range(0, len(home), ROWS):
                    own = nodes[home[p : p + ROWS]]
                    hit = (x[p : p + ROWS] @ y.T >= threshold) & (own[:, None] != ids[None, :])
                    if hit.any():
                        partners[p : p + ROWS] += (hit @ weights).astype(np.int64)
                        pairs = _spanning(hit, own, ids)
                        a.append(pairs[0])
                        b.append(pairs[1])
            some = partners > 0
            if some.any():
                a, b, n = np.concatenate(a), np.concatenate(b), partners[some]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([a, nodes[home][some]])),
                        pa.concat_arrays([pa.array(b), pa.nulls(len(n), pa.int64())]),
                        pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(n)]),
                    ],
                    names=["a", "b", "n"],
                )

    return run


def _dealt(rows: DataFrame, blocks: DataFrame, keys: list[str], both_ways: bool, few: int) -> DataFrame:
    """The rows (node, home, ...) of the cells ``keys``, dealt over pairs (s, t) of
    blocks: in ``role`` 1 a row is one of block s that is at home here, in role 2
    one of block t, in role 3 both.  ``blocks`` has, for every cell, its ``rows``
    and how many s and t there are.  Two blocks of home rows meet ``both_ways`` or
    once.  ``task`` says which task takes a pair; small cells share one."""
    ss, ts = F.sequence(F.lit(0).cast("long"), F.col("s_blocks") - 1), F.sequence(F.lit(0).cast("long"), F.col("t_blocks") - 1)
    own = F.pmod(F.xxhash64("node", F.lit(9)), F.when(F.col("home"), F.col("s_blocks")).otherwise(F.col("t_blocks")))

    def pair(s, t, role):
        return F.struct(s.alias("s"), t.alias("t"), role.cast("int").alias("role"))

    as_home = F.transform(ts, lambda t: pair(F.col("own"), t, F.when(t == F.col("own"), 3).otherwise(1)))
    as_other = F.transform(F.filter(ss, lambda s: (s != F.col("own")) if both_ways else (s < F.col("own"))), lambda s: pair(s, F.col("own"), F.lit(2)))
    visiting = F.transform(ss, lambda s: pair(s, F.col("own"), F.lit(2)))
    pairs = F.explode(F.when(F.col("home"), F.concat(as_home, as_other)).otherwise(visiting)).alias("pair")
    named = rows.join(blocks, keys).withColumn("own", own).select(*rows.columns, "rows", pairs).select(*rows.columns, "rows", "pair.*")
    small = F.pmod(F.xxhash64(*keys), F.lit(few))
    return named.withColumn("task", F.when(F.col("rows") < FEW, small).otherwise(F.xxhash64(*keys, "s", "t"))).drop("rows", "home")


def _sample(rows: DataFrame, total: int) -> dict[int, np.ndarray]:
    """Unit vectors by their length, from a bounded sample of all rows."""
    share = min(1.0, 1.5 * SAMPLE / max(1, total))
    cut = int(share * (1 << 30))
    some = rows.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 30)) <= cut))
    by_dim: dict[int, list[np.ndarray]] = {}
    for batch in some.select("label", "embedding").limit(SAMPLE).toArrow().to_batches():
        for _, _, x in _scaled(batch):
            by_dim.setdefault(x.shape[1], []).append(x)
    return {d: unit(np.unique(np.concatenate(v), axis=0)) for d, v in by_dim.items()}


def link_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """One row for every row of ``vectors`` (vec_id, embedding, label): vec_id,
    n_links, component_id, kept.  Rows that share a vec_id and a vector are
    copies of one another like any others; a null vec_id names no component and
    is never kept."""
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    total = rows.count()
    cells = max(1, min(MAX_CELLS, -(-total // CELL_VECTORS)))
    frames = {d: fit(x, cells) for d, x in _sample(rows, total).items()} if cells > 1 else {}
    few = max(4 * vectors.sparkSession.sparkContext.defaultParallelism, total // (4 * FEW))

    def hashed(with_code: bool, name: str) -> DataFrame:
        read = rows.mapInArrow(_coded(frames, with_code), "vec_id long, label long, dim int, key binary, cell int, data binary")
        return read.select("vec_id", "label", "dim", "cell", F.col("data").alias(name), F.when(F.col("key").isNotNull(), F.xxhash64("key")).alias("h1"), F.when(F.col("key").isNotNull(), F.xxhash64(F.lit(1), "key")).alias("h2"))

    node = F.xxhash64("label", "h1", "h2").alias("node")
    keyed = staged(hashed(True, "code"), "vectors", BATCH)
    nodes = staged(
        keyed.filter(F.col("h1").isNotNull())
        .groupBy("label", "h1", "h2")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first(F.struct("dim", "cell", "code")).alias("first"))
        .select(node, "label", "h1", "h2", "copies", "least", "first.*"),
        "vector-nodes",
    )
    sizes = nodes.groupBy("dim", "label").agg(F.ceil(F.count("*") / PART).alias("parts"))
    parted = nodes.select("node", "dim", "label", "cell", "code").join(sizes, ["dim", "label"])
    part = F.floor(F.col("cell").cast("long") * F.col("parts") / cells).alias("part")
    # visitors of a part are dealt over more blocks than those at home, as they may be many more
    halls = parted.select("dim", "label", part, "parts").groupBy("dim", "label", "part").agg(F.count("*").alias("rows"), F.max("parts").alias("parts")).withColumn("s_blocks", F.ceil(F.col("rows") / (2 * PART)))
    halls = halls.withColumn("t_blocks", F.greatest("s_blocks", F.ceil(F.col("parts") / 8))).drop("parts")
    placed = parted.mapInArrow(_places(frames, cells, threshold), "node long, dim int, label long, cell int, code binary, part long, home boolean")
    near = staged(
        _dealt(placed, halls, ["dim", "label", "part"], False, few).groupBy("task").applyInArrow(_search(frames, threshold), "node long, dim int, label long, cell int, at int").distinct(),
        "vector-near",
        BATCH,
    )
    at_home = near.select("node", "dim", "label", "cell", F.lit(True).alias("home")).distinct()
    calls = at_home.unionByName(near.filter("at <> cell").select("node", "dim", "label", F.col("at").alias("cell"), F.lit(False).alias("home")))
    halls = calls.groupBy("dim", "label", "cell").agg(F.count("*").alias("rows")).withColumn("s_blocks", F.ceil(F.col("rows") / BLOCK)).withColumn("t_blocks", F.col("s_blocks"))
    own = hashed(False, "vector").filter(F.col("h1").isNotNull()).select(node, "vector")
    own = maybe_in(own, "node", bloom(at_home, "node")).groupBy("node").agg(F.first("vector").alias("vector"), F.count("*").alias("copies"))
    compared = _dealt(calls, halls, ["dim", "label", "cell"], True, few).join(own, "node")
    found = staged(compared.groupBy("task").applyInArrow(_compare(threshold, np.float32 if single else np.float64), "a long, b long, n long"), "vector-links", BATCH)
    partners = found.filter(F.col("b").isNull()).groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("partners"))
    linked = components(found.filter(F.col("b").isNotNull()).select("a", "b"))
    joined = nodes.drop("dim", "cell", "code").join(linked, "node", "left").withColumn("c", F.coalesce("component", "node")).join(partners, "node", "left")
    least = joined.groupBy("c").agg(F.min("least").alias("component_id"))
    named = joined.join(least, "c").select("label", "h1", "h2", (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = keyed.select("vec_id", "label", "h1", "h2").join(named, ["label", "h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")
    )
