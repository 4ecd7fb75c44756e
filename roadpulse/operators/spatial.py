"""Spatial join of lines on a grid whose crowded cells are quartered.

Lines are taken apart into straight pieces. Each piece goes to the grid cells it touches and pieces meet by equality of the cell. Where a
cell would bring too many pieces together it is split into four, level by level, as long as that saves more pairs than it makes
rows; so a dense place costs smaller cells instead of more pairs. What stays crowded at the last level,
and where smaller cells do not help, as with many lines on top of each other, is dealt to blocks.

Two pieces that touch several cells together meet in each, but leave the join in one only: the cell of the point
of the right piece that is nearest to the left one. Every pair of pieces therefore comes once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import geometry as geo
from roadpulse.session import cut_lineage, keep_small

CELL_DEGREES = 0.002
# A cell with more pairs of pieces than this may be split, and its quarters with a sixteenth of it, down to the least size in
# degrees (about 2 m) or the reach of the join; a split has to save this many pairs for each row it makes.
CELL_PAIRS = 4096
ROW_PAIRS = 5
LEAST_CELL = 2e-5
# Rows of one side that meet those of the other in one task, in one cell: some seconds of box tests at most.
CELL_ROWS = 10_000
# Margin in degrees against rounding at cell borders, about 0.1 mm.
MARGIN = 1e-9


def line_pieces(lines: DataFrame, ids: list[str], line: str, keep: list[str] | None = None) -> DataFrame:
    """Straight pieces of every line: ids, kept columns, ``part`` (0-based), ``parts``, ``closed``, ends."""
    carried = [*ids, *(keep or [])]
    split = lines.selectExpr(
        *carried, f"size({line}) - 1 as parts", f"{geo.start_point(line)} = {geo.end_point(line)} as closed",
        f"posexplode({geo.pieces(line)}) as (part, p)")
    return split.select(*carried, "parts", "closed", "part", "p.x1", "p.y1", "p.x2", "p.y2")


def _with_box(pieces: DataFrame, prefix: str, grow: float) -> DataFrame:
    """Pieces with all four coordinates, no other can be near anything; their columns get the prefix, their box is added.

    As coordinates are then known not to be NULL, the code Spark generates for a pair has no test for it in every step. With these tests it
    passes the 8,000 bytes up to which the JVM compiles a method, and each pair would be worked out by the interpreter.
    """
    ends = ("x1", "y1", "x2", "y2")
    known = pieces.filter(" and ".join(f"{c} is not null" for c in ends)).withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ends})
    box = [f"{pick}({prefix}{axis}1, {prefix}{axis}2) {sign} {grow!r}D as {prefix}{axis}{end}"
           for axis in "xy" for end, pick, sign in (("min", "least", "-"), ("max", "greatest", "+"))]
    return known.selectExpr(*[f"{c} as {prefix}{c}" for c in pieces.columns]).selectExpr("*", *box)


def _touched(prefix: str, grow: float, size: float, parent: bool = False) -> str:
    """Cells of one size that a piece, grown by ``grow``, touches: ``array<struct<cx,cy>>``.

    Column by column, rows follow from the stretch of the piece over that column, so a long
    slanted piece costs its length in cells and not its box. With ``parent`` only the quarters of the row's own cell count.
    """
    x1, y1, xmin, xmax, ymin, ymax = (prefix + c for c in ("x1", "y1", "xmin", "xmax", "ymin", "ymax"))
    slope = f"(({prefix}y2 - {y1}) / nullif({prefix}x2 - {x1}, 0))"

    def cell_range(low: str, high: str, own: str) -> str:
        lo, hi = f"floor(({low} - {MARGIN}D) / {size!r}D)", f"floor(({high} + {MARGIN}D) / {size!r}D)"
        if parent:
            lo, hi = f"greatest({lo}, 2 * {own})", f"least({hi}, 2 * {own} + 1)"
        return f"if({lo} <= {hi}, sequence({lo}, {hi}), array())"

    def y_at(x: str) -> str:
        return f"{y1} + ({x} - {x1}) * {slope}"

    left = f"greatest({xmin}, qx * {size!r}D - {grow + MARGIN!r}D)"
    right = f"least({xmax}, (qx + 1) * {size!r}D + {grow + MARGIN!r}D)"
    # Past the ends of the piece the straight rule overshoots; the box bounds it again.
    low = f"coalesce(greatest(least({y_at(left)}, {y_at(right)}) - {grow!r}D, {ymin}), {ymin})"
    high = f"coalesce(least(greatest({y_at(left)}, {y_at(right)}) + {grow!r}D, {ymax}), {ymax})"
    rows = cell_range("b.low", "b.high", "cy")
    return (f"flatten(transform({cell_range(xmin, xmax, 'cx')}, qx -> flatten(transform("
            f"array(named_struct('low', {low}, 'high', {high})), b -> transform({rows}, "
            f"qy -> named_struct('cx', qx, 'cy', qy))))))")


class _Side:
    """One side's pieces with their boxes, and the cells they touch at each level."""

    def __init__(self, pieces: DataFrame, prefix: str, ids: list[str], grow: float, cell: float):
        self.boxed, self.prefix, self.ids, self.grow, self.cell = _with_box(pieces, prefix, grow), prefix, ids, grow, cell
        self.columns = self.boxed.columns

    def cells(self) -> DataFrame:
        return self.boxed.selectExpr("*", "0 as level", f"inline({_touched(self.prefix, self.grow, self.cell)})")

    def quarters(self, rows: DataFrame, level: int) -> DataFrame:
        """Rows at ``level`` moved to the quarters they touch."""
        inner = _touched(self.prefix, self.grow, self.cell / 2 ** (level + 1), True)
        return rows.selectExpr(*self.columns, "level + 1 as level", "cx as px", "cy as py", f"inline({inner})")

    def leaves(self, splits: list[DataFrame]) -> DataFrame:
        """Rows in the cells that are left when those of ``splits``, one table a level, are quartered."""
        rows, done = self.cells(), []
        for level, split in enumerate(splits):
            marked = rows.join(split.selectExpr("cx", "cy", "true as split"), ["cx", "cy"], "left")
            done.append(marked.filter("split is null").select(rows.columns))
            rows = self.quarters(marked.filter("split"), level).drop("px", "py")
        for part in done:
            rows = rows.unionByName(part)
        return rows

    def salted(self, rows: DataFrame, crowded: DataFrame | None) -> DataFrame:
        """Rows of crowded cells with their own side's salt, once for each salt of the other side; all others as they are."""
        if crowded is None:
            return rows
        own, other = ("l_salts", "r_salts") if self.prefix == "l_" else ("r_salts", "l_salts")
        hashed = ", ".join(self.prefix + c for c in [*self.ids, "part"])
        mine = f"pmod(xxhash64({hashed}), coalesce({own}, 1))"
        sl, sr = (mine, "s") if self.prefix == "l_" else ("s", mine)
        spread = rows.join(crowded, ["level", "cx", "cy"], "left").selectExpr("*", f"explode(sequence(0L, coalesce({other}, 1) - 1)) as s")
        return spread.selectExpr(*rows.columns, f"{sl} as sl", f"{sr} as sr")


def _sizes(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows of each side a cell has; cells that only one side has are left out."""
    tagged = left.selectExpr(*keys, "1 as l", "0 as r").unionAll(right.selectExpr(*keys, "0 as l", "1 as r"))
    return tagged.groupBy(*keys).agg(F.sum("l").alias("l_rows"), F.sum("r").alias("r_rows")).filter("l_rows > 0 and r_rows > 0")


def meeting_cells(left: _Side, right: _Side, cell_rows: int = CELL_ROWS, cell_pairs: int = CELL_PAIRS) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides' rows in the cells where they meet, and the columns by which they do.

    The cells to split are found by distributed counts, level by level; only crowded cells are counted again, and the tables
    of cells are stored, so later steps see their size. A level with nothing to split ends the search.
    """
    keys = ["level", "cx", "cy"]
    heavy = "l_rows * r_rows > {} or greatest(l_rows, r_rows) > " + str(cell_rows)
    rows, splits, kept = [s.cells() for s in (left, right)], [], []
    crowded = keep_small(_sizes(*rows, keys).filter(heavy.format(cell_pairs)))
    while not crowded.isEmpty():
        level = len(splits)
        if left.cell / 2 ** (level + 1) < max(LEAST_CELL, left.grow):
            kept.append(crowded)
            break
        inner = [s.quarters(r.join(crowded.select("cx", "cy"), ["cx", "cy"], "left_semi"), level) for s, r in zip((left, right), rows)]
        below = cut_lineage(_sizes(*inner, [*keys, "px", "py"]))
        cost = below.groupBy(F.col("px").alias("cx"), F.col("py").alias("cy")).agg(
            F.sum(F.expr(f"l_rows * r_rows + {ROW_PAIRS} * (l_rows + r_rows)")).alias("cost"))
        judged = crowded.join(cost, ["cx", "cy"], "left").withColumn("split", F.expr("coalesce(cost, 0) <= l_rows * r_rows"))
        kept.append(judged.filter("not split").select(crowded.columns))
        splits.append(keep_small(judged.filter("split").select("cx", "cy")))
        rows = [s.quarters(r.join(splits[-1], ["cx", "cy"], "left_semi"), level).drop("px", "py") for s, r in zip((left, right), rows)]
        crowded = keep_small(below.join(splits[-1].selectExpr("cx as px", "cy as py"), ["px", "py"], "left_semi").select(
            *keys, "l_rows", "r_rows").filter(heavy.format(cell_pairs // 16)))
    salts = None
    if kept:
        whole = kept[0]
        for more in kept[1:]:
            whole = whole.unionByName(more)
        salts = keep_small(whole.filter(f"greatest(l_rows, r_rows) > {cell_rows}").selectExpr(
            *keys, f"ceil(l_rows / {cell_rows}) as l_salts", f"ceil(r_rows / {cell_rows}) as r_salts"))
        salts = None if salts.isEmpty() else salts
    sides = [s.salted(s.leaves(splits), salts) for s in (left, right)]
    return *sides, [*keys, "sl", "sr"] if salts is not None else keys


def _in_reach(one: str, other: str, grow: float) -> str:
    """Whether the other piece comes within ``grow`` of the straight line that carries the one piece."""
    ends = [f"{one}{c}" for c in ("x1", "y1", "x2", "y2")]
    sides = ", ".join(geo.side(*ends, f"{other}x{i}", f"{other}y{i}") for i in (1, 2))
    reach = f"{grow + MARGIN!r}D * hypot({one}x2 - {one}x1, {one}y2 - {one}y1)"
    return f"least({sides}) <= {reach} and greatest({sides}) >= -({reach})"


def near_pieces(left: DataFrame, right: DataFrame, left_ids: list[str], right_ids: list[str],
                grow: float = 0.0, cell: float = CELL_DEGREES, cell_rows: int = CELL_ROWS,
                cell_pairs: int = CELL_PAIRS, extra: str | None = None) -> DataFrame:
    """Pairs of pieces that may come within ``grow`` of each other; columns ``l_*``, ``r_*``, and how they lie (``s_*``).

    The boxes meet, the left one grown, and neither piece lies wholly to one side of the other.

    A pair comes once, from the cell of its nearest point. ``extra`` is one more join condition. Both sides are read several
    times (sizes and join), so inputs that are costly to compute should be stored or checkpointed first.
    """
    sides = _Side(left, "l_", left_ids, grow, cell), _Side(right, "r_", right_ids, 0.0, cell)
    cells_l, cells_r, on = meeting_cells(*sides, cell_rows, cell_pairs)
    same = " and ".join(f"a.{c} = b.{c}" for c in on)
    meet = "l_xmin <= r_xmax and l_xmax >= r_xmin and l_ymin <= r_ymax and l_ymax >= r_ymin"
    reach = [_in_reach("l_", "r_", grow), _in_reach("r_", "l_", grow)]
    condition = " and ".join([same, meet, *reach, *([extra] if extra else [])])
    kept = [*sides[0].columns, *sides[1].columns]
    pairs = cells_l.alias("a").join(cells_r.alias("b"), F.expr(condition)).select(*kept, "a.level", "a.cx", "a.cy")
    return _from_nearest_cell(pairs, cell).select(*kept, *_SIDES)


_LEFT, _RIGHT = ("l_x1", "l_y1", "l_x2", "l_y2"), ("r_x1", "r_y1", "r_x2", "r_y2")
# Orientation of each piece's ends against the other piece.
_SIDES = {"s_r1": geo.side(*_LEFT, *_RIGHT[:2]), "s_r2": geo.side(*_LEFT, *_RIGHT[2:]),
          "s_l1": geo.side(*_RIGHT, *_LEFT[:2]), "s_l2": geo.side(*_RIGHT, *_LEFT[2:])}


def _bound(df: DataFrame, **columns: str) -> DataFrame:
    """Columns that are computed once: a one-row generator keeps later filters from being moved below with copies of them."""
    made = ", ".join(f"'{name}', {expression}" for name, expression in columns.items())
    return df.selectExpr("*", f"inline(array(named_struct({made})))")


def _from_nearest_cell(pairs: DataFrame, cell: float) -> DataFrame:
    """Of a pair's rows the one of the cell that holds the point of the right piece nearest to the left one.

    That point is where they cross, or belongs to one of the four ends: an end of the right piece, or the place on it nearest to an end
    of the left piece. It lies on the right piece and in reach of the left one, so both have a row in its cell.
    """
    def share(p: str, a: str, b: str) -> str:
        """Where on a to b the point nearest to p lies, 0 to 1."""
        dx, dy = f"({b.format('x')} - {a.format('x')})", f"({b.format('y')} - {a.format('y')})"
        along = f"(({p.format('x')} - {a.format('x')}) * {dx} + ({p.format('y')} - {a.format('y')}) * {dy})"
        return f"coalesce(greatest(0D, least(1D, {along} / nullif({dx} * {dx} + {dy} * {dy}, 0))), 0D)"

    def gap(p: str, a: str, b: str, at: str) -> str:
        x, y = (f"({a.format(c)} + {at} * ({b.format(c)} - {a.format(c)}) - {p.format(c)})" for c in "xy")
        return f"{x} * {x} + {y} * {y}"

    l1, l2, r1, r2 = "l_{}1", "l_{}2", "r_{}1", "r_{}2"
    found = _bound(pairs, **_SIDES, n_r1=share(r1, l1, l2), n_r2=share(r2, l1, l2), n_l1=share(l1, r1, r2), n_l2=share(l2, r1, r2))
    found = _bound(found, g_r1=gap(r1, l1, l2, "n_r1"), g_r2=gap(r2, l1, l2, "n_r2"), g_l1=gap(l1, r1, r2, "n_l1"), g_l2=gap(l2, r1, r2, "n_l2"))
    found = _bound(found, at="""case when s_r1 * s_r2 <= 0 and s_l1 * s_l2 <= 0 and s_r1 <> s_r2 then s_r1 / (s_r1 - s_r2)
        when g_r1 <= least(g_r2, g_l1, g_l2) then 0D when g_r2 <= least(g_l1, g_l2) then 1D when g_l1 <= g_l2 then n_l1 else n_l2 end""")
    here = [f"floor((r_{c}1 + at * (r_{c}2 - r_{c}1)) / ({cell!r}D / shiftleft(1, level))) = c{c}" for c in "xy"]
    return found.filter(" and ".join(here))


def with_sides(pairs: DataFrame) -> DataFrame:
    """Adds the orientation of each piece's ends against the other piece, unless it is there, and whether the pieces meet."""
    have = {c: e for c, e in _SIDES.items() if c not in pairs.columns}
    sided = pairs.selectExpr("*", *[f"{e} as {c}" for c, e in have.items()])
    boxes = " and ".join(f"least(l_{c}1, l_{c}2) <= greatest(r_{c}1, r_{c}2) and greatest(l_{c}1, l_{c}2) >= least(r_{c}1, r_{c}2)"
                         for c in "xy")
    return sided.selectExpr("*", f"{boxes} and s_r1 * s_r2 <= 0 and s_l1 * s_l2 <= 0 as meets")


def intersecting_lines(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                       left_line: str = "geometry", right_line: str = "geometry", **grid) -> DataFrame:
    """Pairs of line ids whose lines share a point: columns ``left_id``, ``right_id``. Bent lines can meet by several pieces."""
    near = near_pieces(line_pieces(left, [left_id], left_line), line_pieces(right, [right_id], right_line),
                       [left_id], [right_id], **grid)
    met = with_sides(near).filter("meets")
    return met.select(F.col("l_" + left_id).alias(left_id), F.col("r_" + right_id).alias(right_id)).distinct()


def capsule_interval(pairs: DataFrame, radius: float) -> DataFrame:
    """Stretch of each right piece within ``radius`` of the left piece, as fractions ``lo``..``hi``.

    The points near a straight piece form a capsule: a slab along it and a circle at either
    end. A capsule is convex, so the three stretches make up one; NULL when there is none.
    """
    def over(top: str, bottom: str) -> str:
        return f"({top}) / nullif({bottom}, 0)"

    step = pairs.selectExpr(
        "*", "r_x1 - l_x1 as px", "r_y1 - l_y1 as py", "r_x2 - r_x1 as dx", "r_y2 - r_y1 as dy",
        "l_x2 - l_x1 as ex", "l_y2 - l_y1 as ey")
    step = step.selectExpr(
        "*", "ex * ex + ey * ey as ee", "dx * dx + dy * dy as dd", "px * ex + py * ey as pe", "dx * ex + dy * ey as de",
        "px * dx + py * dy as pd", "px * px + py * py as pp", "ex * py - ey * px as ep", "ex * dy - ey * dx as ed")
    # The second circle is about the far end, so its start vector is p - e.
    step = step.selectExpr(
        "*", f"{over('pe', 'ee')} as s0", f"{over('de', 'ee')} as s1",
        f"{over('ep', 'sqrt(ee)')} as h0", f"{over('ed', 'sqrt(ee)')} as h1",
        "pd - de as qd", "pp - 2 * pe + ee as qq")
    r, r2 = f"{radius!r}D", f"{radius * radius!r}D"
    step = step.selectExpr("*", f"pd * pd - dd * (pp - {r2}) as disc1", f"qd * qd - dd * (qq - {r2}) as disc2")

    def linear(base: str, rate: str, low: str, high: str, name: str) -> list[str]:
        """Where low <= base + t * rate <= high."""
        t1, t2 = over(f"{low} - {base}", rate), over(f"{high} - {base}", rate)
        always = f"{base} between {low} and {high}"
        return [f"case when {rate} <> 0 then {pick}({t1}, {t2}) when {always} then {still} end as {name}_{end}"
                for end, pick, still in (("lo", "least", "0D"), ("hi", "greatest", "1D"))]

    def circle(b: str, disc: str, name: str) -> list[str]:
        return [over(f"-{b} {sign} sqrt(if({disc} >= 0, {disc}, null))", "dd") + f" as {name}_{end}"
                for end, sign in (("lo", "-"), ("hi", "+"))]

    step = step.selectExpr("*", *linear("h0", "h1", f"-{r}", r, "wide"), *linear("s0", "s1", "0D", "1D", "long"),
                           *circle("pd", "disc1", "near"), *circle("qd", "disc2", "far"))
    # greatest and least skip NULL, so a missing stretch is kept missing by hand.
    step = step.selectExpr(
        "*",
        "if(wide_lo is null or long_lo is null, null, greatest(wide_lo, long_lo, 0D)) as slab_lo",
        "if(wide_lo is null or long_lo is null, null, least(wide_hi, long_hi, 1D)) as slab_hi",
        "if(near_lo is null, null, greatest(near_lo, 0D)) as one_lo", "if(near_lo is null, null, least(near_hi, 1D)) as one_hi",
        "if(far_lo is null, null, greatest(far_lo, 0D)) as two_lo", "if(far_lo is null, null, least(far_hi, 1D)) as two_hi")

    def real(end: str) -> str:
        return ", ".join(f"if({n}_lo <= {n}_hi, {n}_{end}, null)" for n in ("slab", "one", "two"))

    return step.selectExpr(*pairs.columns, f"least({real('lo')}) as lo", f"greatest({real('hi')}) as hi")


def covered_metres(stretches: str) -> str:
    """Metres under a set of stretches, overlaps counted once.

    ``stretches`` is ``array<struct<part, lo, hi, x1, y1, x2, y2>>`` over the pieces of one
    line. Sorted, each adds what reaches past the furthest end so far on its piece.
    """
    start = "if(acc.part = s.part, greatest(acc.end, s.lo), s.lo)"
    at = [f"s.{c}1 + n.{end} * (s.{c}2 - s.{c}1)" for end in ("start", "end") for c in "xy"]
    fresh = f"if(n.end > n.start, {geo.metres(*at)}, 0D)"
    added = (f"transform(array(named_struct('start', {start}, 'end', greatest({start}, s.hi))), "
             f"n -> named_struct('part', s.part, 'end', n.end, 'total', acc.total + {fresh}))[0]")
    return (f"aggregate(array_sort({stretches}), named_struct('part', -1, 'end', 0D, 'total', 0D), "
            f"(acc, s) -> {added}, acc -> acc.total)")
