"""Point-in-time features: what was known of a key at a time, by divide and conquer over event time and availability."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.llm.shared import materialize, partitions

#: Starts and asks that a leaf may hold: a key with more is cut into cells of time, of the largest width whose fullest cell has no more.
LEAF = 16_384
#: Widths of cells that are tried, in bits of a microsecond; the second list, for keys that the first leaves too full.
WIDTHS, FINER = tuple(range(40, 18, -2)), tuple(range(18, -1, -2))
#: Rows of a task that answers asks, on average.
TASK = 100_000
#: Cells that one prefix maximum runs over, in bits.
RUN = 12
LEAST, MOST = -(1 << 62), 1 << 62
#: Added to times, so that numbers of cells aren't negative.
BEFORE = 1 << 61


def _widths(points: DataFrame, capacity: int) -> DataFrame:
    """key and w (bits) of each key of the points (key, x), as a written table. Counts are combined before they move: no task sees a key whole."""

    def widest(of: DataFrame, widths: Sequence[int], least: int) -> DataFrame:
        cells = of.groupBy("key", F.shiftright("x", widths[-1]).alias("c")).agg(F.count(F.lit(1)).alias("n"))
        coarser = cells.select("key", F.explode(F.array(*map(F.lit, widths))).alias("w"), "c", "n").withColumn("c", F.expr(f"shiftright(c, w - {widths[-1]})"))
        fullest = coarser.groupBy("key", "w", "c").agg(F.sum("n").alias("n")).groupBy("key", "w").agg(F.max("n").alias("n"))
        return fullest.groupBy("key").agg(F.coalesce(F.max(F.when(F.col("n") <= capacity, F.col("w"))), F.lit(least)).alias("w"))

    first = materialize(widest(points, WIDTHS, -1), "pit-widths", narrow=True)
    rest = first.where("w < 0").select("key")
    if rest.isEmpty():
        return first
    return materialize(first.where("w >= 0").unionByName(widest(points.join(rest, "key", "left_semi"), FINER, 0)), "pit-widths", narrow=True)


def _cell(time: str) -> Column:
    """The number (not negative) of the cell that a time lies in; a key without a width is one cell."""
    return F.when(F.col("w").isNull(), F.lit(0).cast("long")).otherwise(F.expr(f"shiftright({time} + {BEFORE}, w)"))


def _reach(ends: DataFrame) -> DataFrame:
    """For each cell (key, kind, item, cell, u: the latest end of its intervals) the latest end in the cells before it, where there is one.

    Prefix maxima run over blocks of 2 ** RUN cells, then over blocks of these, as often as the cells' numbers ask for: no window has more rows than that.
    """
    of = ["key", "kind", "item"]
    span = ends.agg(F.min("cell").alias("lo"), F.max("cell").alias("hi")).first()
    levels = max(1, -(-((span.lo or 0) ^ (span.hi or 0)).bit_length() // RUN))
    found, level = [], ends
    for k in range(levels):
        run = W.partitionBy(*of, F.shiftright("cell", RUN)).orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
        before = level.select(*of, F.col("cell").alias("block"), F.max("u").over(run).alias("u")).where("u IS NOT NULL")
        own = ends.select(*of, "cell", F.shiftright("cell", RUN * k).alias("block"))
        found.append(before.withColumnRenamed("block", "cell") if k == 0 else own.join(before, [*of, "block"]).select(*of, "cell", "u"))
        level = level.groupBy(*of, F.shiftright("cell", RUN).alias("cell")).agg(F.max("u").alias("u"))
    return reduce(DataFrame.unionByName, found).groupBy(*of, "cell").agg(F.max("u").alias("u"))


def coalesced(covers: DataFrame) -> DataFrame:
    """Disjoint intervals (key, w, kind, x, u) with the union of the intervals of each item: covers (key, w, kind, item, x, u).

    An interval gives what the earlier ones of its item leave of it, by the latest end among these: in its cell by a window, and from the
    cells before by prefix maxima (``_reach``). So a time lies in one interval of each item that covers it, and counting intervals
    counts items.
    """
    covers = covers.withColumn("cell", _cell("x"))
    of = ["key", "kind", "item", "cell"]
    ends = materialize(covers.where("w IS NOT NULL").groupBy(*of).agg(F.max("u").alias("u")), "pit-ends", narrow=True)
    before = _reach(ends).select("key", F.lit(None).cast("int").alias("w"), "kind", "item", F.lit(LEAST).alias("x"), "u", "cell")
    run = W.partitionBy(*of).orderBy("x", "u").rowsBetween(W.unboundedPreceding, -1)
    left = covers.unionByName(before).withColumn("x0", F.col("x")).withColumn("x", F.greatest("x", F.max("u").over(run)))
    return left.where((F.col("x0") > LEAST) & (F.col("x") < F.col("u"))).select("key", "w", "kind", "x", "u")


SUMS = ("n", "flag", "cents")


def _summed() -> list[Column]:
    return [*[F.sum(c).alias(c) for c in SUMS], F.max("last").alias("last")]


def _rounds(intervals: DataFrame, cells_asked: DataFrame) -> DataFrame:
    """What intervals of a cut key add to every ask of cells that lie whole between their start's cell and their end's: key, cell, kind, sums, last.

    One round a level. A block is two halves; what starts in the left half and ends beyond the right one is available to all the right half's
    asks and has not left the window, and so it is for the left half where the end lies in the right one: events, summed by the halves
    of both coordinates, meet the asks' cells by an equal number of the half. Then halves become blocks. Sums of cells move, never events.
    """
    of = ["key", "kind"]
    last = F.max(F.when(F.col("id").isNotNull(), F.struct("u", "id"))).alias("last")
    cells = intervals.withColumns({"i": _cell("x"), "j": _cell("u")}).where("i + 1 < j")
    cells = materialize(cells.groupBy(*of, "i", "j").agg(*[F.sum(c).alias(c) for c in SUMS], last), "pit-cells", narrow=True)
    found, level = [], 0
    while not cells.isEmpty():
        right = F.when((F.col("i") % 2 == 0) & (F.col("i") + 1 < F.col("j")), F.col("i") + 1)
        left = F.when((F.col("j") % 2 != 0) & (F.col("j") - 1 > F.col("i")), F.col("j") - 1)
        halves = cells.withColumn("half", F.explode(F.array(right, left))).where("half IS NOT NULL").groupBy(*of, "half").agg(*_summed())
        asked = cells_asked.withColumn("half", F.shiftright("cell", level))
        found.append(materialize(asked.join(halves, ["key", "half"]).drop("half"), "pit-round", narrow=True))
        up = cells.withColumns({"i": F.shiftright("i", 1), "j": F.shiftright("j", 1)}).where("i + 1 < j")
        cells, level = materialize(up.groupBy(*of, "i", "j").agg(*_summed()), "pit-cells", narrow=True), level + 1
    empty = cells.select("key", F.lit(0).cast("long").alias("cell"), "kind", *SUMS, "last")
    return reduce(DataFrame.unionByName, found, empty).groupBy("key", "cell", "kind").agg(*_summed())


def _answer(kinds: int, latest: Sequence[int]):
    """Answers the asks (kind -1) of whole leaves: by kind the sums over intervals with x <= t < u, and the id of the latest end."""

    def run(table: pa.Table) -> pa.Table:
        get = lambda c, null=0: np.asarray(pc.fill_null(table.column(c), null).combine_chunks())
        key, cell, kind, x, u, n, flag, cents, ids = get("key"), get("cell"), get("kind"), get("x"), get("u"), get("n", 1), get("flag"), get("cents"), get("id", LEAST)
        order = np.lexsort((cell, key))
        new = np.r_[0, (key[order][1:] != key[order][:-1]) | (cell[order][1:] != cell[order][:-1])]
        leaf = np.empty(len(key), np.int64)
        leaf[order] = np.cumsum(new)[: len(key)]
        times, place = np.unique(np.concatenate([x, u]), return_inverse=True)
        starts, ends = leaf * len(times) + place[: len(x)], leaf * len(times) + place[len(x) :]
        asks = np.nonzero(kind == -1)[0]
        at = starts[asks]
        sums = np.zeros((3, len(asks), kinds), np.int64)
        last_u, last_id = np.full((len(asks), kinds), LEAST), np.full((len(asks), kinds), LEAST)
        for k in range(kinds):
            own = np.nonzero(kind == k)[0]
            if not len(own):
                continue
            first = np.argsort(starts[own], kind="stable")
            by_start, by_end = own[first], own[np.argsort(ends[own], kind="stable")]
            begun, over = np.searchsorted(starts[by_start], at, "right"), np.searchsorted(ends[by_end], at, "right")
            for s, values in enumerate((n, flag, cents)):  # what has begun less what is over; other leaves' intervals are in both
                sums[s, :, k] = np.r_[0, np.cumsum(values[by_start])][begun] - np.r_[0, np.cumsum(values[by_end])][over]
            if k in latest and len(by_start := by_start[u[by_start] < MOST]):
                ranked = np.lexsort((ids[by_start], u[by_start]))
                rank = np.empty(len(by_start), np.int64)
                rank[ranked] = np.arange(len(by_start))
                best = np.maximum.accumulate(leaf[by_start] * len(by_start) + rank)
                begun = np.searchsorted(starts[by_start], at, "right")
                hit = best[np.maximum(begun - 1, 0)]
                event = by_start[ranked[hit % len(by_start)]]
                there = (begun > 0) & (hit // len(by_start) == leaf[asks]) & (u[event] > x[asks])
                last_u[there, k], last_id[there, k] = u[event[there]], ids[event[there]]
        lists = lambda m, null=None: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * kinds), pa.array(m.ravel(), mask=None if null is None else m.ravel() == null))
        return pa.table({"id": pa.array(ids[asks]), "t": pa.array(x[asks]), "n": lists(sums[0]), "flags": lists(sums[1]), "cents": lists(sums[2]), "last_u": lists(last_u, LEAST), "last_id": lists(last_id, LEAST)})

    return run


def dominance(intervals: DataFrame, asks: DataFrame, kinds: int, latest: Sequence[int] = (), distinct: Mapping[int, int] | None = None, capacity: int = LEAF) -> DataFrame:
    """id and t of each ask (key, id, t) and, in arrays by kind: n, flags, cents, over the key's intervals with x <= t < u, and last_u and last_id of the latest.

    Intervals: key, kind (from 0), x, u, flag, cents, id (longs, but kind: int) and item. An event of time ts that is available from a on, seen in a window of d,
    is the interval from max(ts, a) to ts + d. ``latest``: kinds whose latest end, and its largest id (null least), is asked for. ``distinct``: for a kind, the
    kind that counts its different items. Rows with a null key, x or u count nowhere; an ask with a null key or t has no answer; equal rows count each;
    no asks give no row.

    A key of more than ``capacity`` starts and asks is full. Its equal intervals become one with their sums, and of the intervals of an item that
    end together the longest stays; then it is cut into cells of time. Within a cell, and in the cell in which an interval ends, a task
    compares times; what lies whole between is added by rounds of halves (``_rounds``), so a key of any size is dealt out. Only the asks
    of one microsecond of one key stay together.
    """
    long = lambda n: F.lit(n).cast("long")
    named = intervals.where("key IS NOT NULL AND x IS NOT NULL AND u IS NOT NULL AND x < u")
    events = materialize(named.select("key", F.col("kind").cast("int").alias("kind"), "x", "u", "flag", "cents", "id", "item"), "pit-events")
    asks = materialize(asks.where("key IS NOT NULL AND t IS NOT NULL").select("key", "id", "t"), "pit-asks")
    counts = events.select("key").unionAll(asks.select("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    full = materialize(counts.where(F.col("n") > capacity).select("key", F.lit(True).alias("full")), "pit-full", narrow=True)
    # every row passes both joins, whatever its key: what is full is told apart by what is written
    events, asks = (materialize(df.join(full, "key", "left").withColumn("full", F.coalesce("full", F.lit(False))), "pit-marked") for df in (events, asks))
    starts = events.where("full").select("key", "kind", "x", "u").distinct().select("key", "x")
    widths = _widths(starts.unionAll(asks.where("full").select("key", F.col("t").alias("x"))), capacity)
    events, asks = (materialize(df.drop("full").join(widths, "key", "left"), "pit-placed") for df in (events, asks))
    cold, hot = "w IS NULL", "w IS NOT NULL"
    apart = events.where(cold).select("key", "w", "kind", "x", "u", long(1).alias("n"), "flag", "cents", "id")
    placed = events.where(hot).groupBy("key", "w", "kind", "x", "u").agg(F.count(F.lit(1)).alias("n"), F.sum("flag").alias("flag"), F.sum("cents").alias("cents"), F.max("id").alias("id"))
    if distinct:
        to = F.create_map(*[F.lit(v) for pair in distinct.items() for v in pair])
        covers = events.where(F.col("kind").isin(*distinct) & F.col("item").isNotNull()).withColumn("kind", to[F.col("kind")])
        longest = covers.where(hot).groupBy("key", "w", "kind", "item", "u").agg(F.min("x").alias("x"))
        pieces = materialize(coalesced(covers.where(cold).select("key", "w", "kind", "item", "x", "u").unionByName(longest)), "pit-pieces")
        plain = {"flag": long(0), "cents": long(0), "id": F.lit(None).cast("long")}
        apart = apart.unionByName(pieces.where(cold).withColumns({"n": long(1), **plain}))
        placed = placed.unionByName(pieces.where(hot).groupBy("key", "w", "kind", "x", "u").agg(F.count(F.lit(1)).alias("n")).withColumns(plain))
    placed = materialize(placed, "pit-full-events")
    placed_asks = asks.withColumn("cell", _cell("t"))
    base = _rounds(placed, materialize(placed_asks.where(hot).select("key", "cell").distinct(), "pit-asked", narrow=True))

    both = F.when(_cell("x") < _cell("u"), F.array(_cell("x"), _cell("u"))).otherwise(F.array(_cell("x")))
    none = F.lit(None).cast("long")
    columns = ["key", "cell", "kind", "x", "u", *SUMS, "id"]
    own = placed.withColumn("cell", F.explode(both)).select(*columns).unionByName(apart.withColumn("cell", long(0)).select(*columns))
    whole = base.select("key", "cell", "kind", F.lit(LEAST).alias("x"), F.lit(MOST).alias("u"), *SUMS, none.alias("id"))
    late = base.where("last IS NOT NULL").select("key", "cell", "kind", F.lit(LEAST).alias("x"), F.col("last.u").alias("u"), *[long(0).alias(c) for c in SUMS], F.col("last.id").alias("id"))
    asked = placed_asks.select("key", "cell", F.lit(-1).alias("kind"), F.col("t").alias("x"), none.alias("u"), *[none.alias(c) for c in SUMS], "id")
    rows = own.unionByName(whole).unionByName(late).unionByName(asked)
    tasks = max(4 * partitions(events.sparkSession), -(-2 * events.count() // TASK))
    schema = "id long, t long, n array<long>, flags array<long>, cents array<long>, last_u array<long>, last_id array<long>"
    return rows.withColumn("task", F.pmod(F.xxhash64("key", "cell"), F.lit(tasks)).cast("int")).groupBy("task").applyInArrow(_answer(kinds, tuple(latest)), schema)


SECOND, DAY = 1_000_000, 86_400_000_000
DELAY, AHEAD = 240 * 60 * SECOND, 7 * DAY
WINDOWS = (2, 14)


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a timestamp; one without a zone is UTC, whatever the session's zone."""
    c = F.col(f"`{column}`")
    if dict(df.dtypes)[column] == "timestamp_ntz":
        return (F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3600 + F.minute(c) * 60) * SECOND + (F.expr(f"extract(SECOND FROM `{column}`)") * SECOND).cast("long")
    return F.unix_micros(c.cast("timestamp"))


def cents(value: Column) -> Column:
    """floor(100 x + 0.5), 0 for null and what isn't finite."""
    x = F.floor(value.cast("double") * 100 + 0.5)
    return F.when(value.isNull() | F.isnan(value.cast("double")) | (F.abs(value.cast("double")) == float("inf")), F.lit(0)).otherwise(x).cast("long")


CLICK, SALE, LINE, ITEM, LABEL = 0, 2, 4, 6, 8


def sale_features(clicks: DataFrame, sales: DataFrame, lines: DataFrame) -> DataFrame:
    """The point-in-time table of sales; see ``op12_feature_table`` for its columns. Rows that equal clicks in all their columns count once.

    A sale without an id has no time of its own: it counts, but isn't asked for. A sale_id that comes twice is asked for twice, and its lines belong
    to both. Lines without a sale or a shipping time, and events without a client, a time or an arrival, count nowhere; texts and other columns
    play no part, except that clicks must differ in one of their seven columns to count as two. Of clicks at one time one without an id is the last to be named.
    """
    whole = clicks.where("client_id IS NOT NULL AND ts IS NOT NULL AND arrived_at IS NOT NULL").select("click_id", "ts", "arrived_at", "client_id", "kind", "value", "props").distinct()
    seen = whole.select(F.col("client_id").cast("long").alias("key"), micros(whole, "ts").alias("ts"), (micros(whole, "arrived_at") + DELAY).alias("a"), F.coalesce(F.col("kind") == "purchase", F.lit(False)).cast("long").alias("flag"), cents(F.col("value")).alias("cents"), F.col("click_id").cast("long").alias("id"))
    sold = sales.select(F.col("sale_id").cast("long").alias("id"), F.col("client_id").cast("long").alias("key"), micros(sales, "sold_at").alias("ts"), (micros(sales, "arrived_at") + DELAY).alias("a"), cents(F.col("total")).alias("cents")).where("key IS NOT NULL AND ts IS NOT NULL")
    shipped = lines.select(F.col("sale_id").cast("long").alias("id"), F.col("item_id").cast("long").alias("item"), micros(lines, "shipped_at").alias("shipped"), cents(F.col("amount")).alias("cents")).where("id IS NOT NULL AND shipped IS NOT NULL")
    bought = shipped.join(sold.where("id IS NOT NULL AND a IS NOT NULL").select("id", "key", "ts", "a"), "id").withColumn("a", F.greatest("a", "shipped"))

    none = F.lit(None).cast("long")

    def seen_in(df: DataFrame, kind: int, flag: Column, id_: Column, item: Column) -> DataFrame:
        windows = F.explode(F.array(*[F.struct(F.lit(kind + k).alias("kind"), F.lit(d * DAY).alias("d")) for k, d in enumerate(WINDOWS)]))
        out = df.withColumn("_w", windows).select("key", "_w.kind", F.greatest("ts", "a").alias("x"), (F.col("ts") + F.col("_w.d")).alias("u"), flag.alias("flag"), "cents", id_.alias("id"), item.alias("item"))
        return out.where("x < u")

    zero = F.lit(0).cast("long")
    coming = sold.select("key", F.lit(LABEL).alias("kind"), (F.col("ts") - AHEAD).alias("x"), F.col("ts").alias("u"), zero.alias("flag"), zero.alias("cents"), none.alias("id"), none.alias("item"))
    available = sold.where("a IS NOT NULL")
    intervals = reduce(DataFrame.unionByName, [seen_in(seen, CLICK, F.col("flag"), F.coalesce("id", F.lit(LEAST)), none), seen_in(available, SALE, zero, none, none), seen_in(bought, LINE, zero, none, F.col("item")), coming])
    late = F.crc32(F.col("id").cast("string").cast("binary")) % 259_200 * SECOND
    asks = sold.where("id IS NOT NULL").select("key", "id", (F.col("ts") + late).alias("t"))
    found = dominance(intervals, asks, LABEL + 1, latest=[CLICK, CLICK + 1], distinct={LINE: ITEM, LINE + 1: ITEM + 1})
    at = lambda name, kind: F.get(F.col(name), F.col("_k") + kind)
    rows = found.withColumn("_k", F.explode(F.array(*[F.lit(k) for k in range(len(WINDOWS))])))
    return rows.select(
        F.col("id").alias("sale_id"),
        F.get(F.array(*map(F.lit, WINDOWS)), F.col("_k")).alias("d"),
        F.col("t").alias("t_us"),
        (F.col("n")[LABEL] > 0).alias("label"),
        at("n", CLICK).alias("n_clicks"),
        at("flags", CLICK).alias("n_purchases"),
        at("cents", CLICK).alias("click_cents"),
        at("last_id", CLICK).alias("last_click_id"),
        at("n", SALE).alias("n_sales"),
        at("cents", SALE).alias("sale_cents"),
        at("n", LINE).alias("n_lines"),
        at("n", ITEM).alias("n_items"),
        at("cents", LINE).alias("line_cents"),
    )


def op12_feature_table(spark, sf_dir: str) -> DataFrame:
    """What was known of each sale's client at the sale's time, over the last 2 and 14 days, and whether the client buys within 7 days (``label``)."""
    return sale_features(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("clicks", "sales", "sale_lines")])
