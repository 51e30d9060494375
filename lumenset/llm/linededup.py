"""Line deduplication in DataFrame functions only: exact repeats by hash, near repeats by a segment-partition edit join.

A line is cut into threshold + 1 segments by its length. If two lines lie within the threshold, a segment of the
shorter one occurs in the longer one at one of few places, so lines meet over hashes of (length, segment number,
substring). Letter counts that differ too much rule pairs out inside the join; the rest are verified by a banded
bit-parallel edit distance. Near lines form classes (connected components); a class keeps its first line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, discard, release, sized, written
from .components import components

#: Common ones first.
LETTERS = "enaitorshlducmgfpwybvkéxjqzöäü ."
PARTS = len(LETTERS) // 16
LAST = (1 << 63) - 1


def probes(threshold: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift) at which a longer line has to be looked up besides its own segments."""
    out = []
    for gap in range(threshold + 1):
        for i in range(threshold + 1):
            low, high = max(-i, gap - (threshold - i)), min(i, gap + (threshold - i))
            out += [(gap, i, shift) for shift in range(low, high + 1) if (gap, shift) != (0, 0)]
    return out


def keyed(lines: DataFrame, threshold: int) -> DataFrame:
    """lines (id, line) with key and own, a row for each place to look: own for a line's segments, which are both stored and looked up.

    The places are exploded from a literal first, so that the expression of a key stays small enough to be compiled.
    Segments are cut from code points of four bytes each: a place in a UTF-8 string would have to be counted out anew.
    """
    parts = threshold + 1
    places = [(0, i, 0, True) for i in range(parts)] + [(*p, False) for p in probes(threshold)]
    literal = F.array(*[F.struct(F.lit(g).alias("gap"), F.lit(i).alias("i"), F.lit(shift).alias("shift"), F.lit(own).alias("own")) for g, i, shift, own in places])
    rows = lines.select("id", F.encode("line", "UTF-32").alias("_wide")).withColumn("_at", F.explode(literal))
    rows = rows.withColumn("_length", F.expr("octet_length(_wide) div 4 - _at.gap"))
    start, end = F.expr(f"_length * _at.i div {parts}"), F.expr(f"_length * (_at.i + 1) div {parts}")
    cut = F.substring(F.col("_wide"), (4 * (start + F.col("_at.shift")) + 1).cast("int"), (4 * (end - start)).cast("int"))
    return rows.select("id", F.xxhash64("_length", "_at.i", cut).alias("key"), F.col("_at.own").alias("own"))


def signature(line: Column, part: int) -> Column:
    """Counts modulo 16 of sixteen of LETTERS, four bits each; part is less than PARTS. Lengths in bytes need no pass over the line."""
    held = F.lit(0).cast("long")
    for x in LETTERS[16 * part : 16 * part + 16]:
        gone = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(x), F.lit("")))
        count = gone if len(x.encode()) == 1 else F.shiftright(gone, 1)  # the others take two bytes
        held = F.shiftleft(held, 4).bitwiseOR(count.bitwiseAND(F.lit(15)).cast("long"))
    return held


def signature_gap(a: Column, b: Column) -> Column:
    """A lower bound of twice the edit distance of the signatures' lines: an edit moves two counts by one at most."""
    fifteen, total = F.lit(15).cast("long"), F.lit(0).cast("long")
    for n in range(16):
        d = F.abs(F.shiftright(a, 4 * n).bitwiseAND(fifteen) - F.shiftright(b, 4 * n).bitwiseAND(fifteen))
        total = total + F.least(d, 16 - d)
    return total


def within_edits(a: Column, b: Column, threshold: int) -> Column:
    """Whether the edit distance of a and b is at most threshold (which must be less than both lengths).

    Hyyro's bit-vector recurrence over a band of 2 * threshold + 1 diagonals, held in one long: bit k of column j
    is row j - threshold + k. The distance is followed along the lowest diagonal down to the last row, then along
    that row, whose 2 * threshold steps at most can each lower it by one: beyond 3 * threshold no more is computed.
    """
    t, width = threshold, 2 * threshold + 1
    mask, low = (1 << width) - 1, 1 << (width - 1)
    let = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))  # noqa: E731  evaluated once, unlike a column named in a lambda
    n = lambda v: F.lit(v).cast("long")

    def ran(s: Column) -> Column:
        x, y, rows = s["x"], s["y"], s["rows"]

        def step(state: Column, j: Column) -> Column:
            same = n(0)
            for k in range(width):
                same = same.bitwiseOR(F.when(F.get(x, j - t + k) == F.get(y, j), n(1 << k)).otherwise(n(0)))

            def with_match(m: Column) -> Column:
                d = (((m.bitwiseAND(state["vp"])) + state["vp"]).bitwiseXOR(state["vp"])).bitwiseOR(m).bitwiseOR(state["vn"]).bitwiseAND(n(mask))

                def with_diagonal(d0: Column) -> Column:
                    hp = state["vn"].bitwiseOR(F.bitwise_not(d0.bitwiseOR(state["vp"]))).bitwiseAND(n(mask))
                    hn = d0.bitwiseAND(state["vp"])
                    down = F.shiftright(d0, 1)
                    row = F.call_function("shiftleft", n(1), (width - 2 - (j - (rows - t))).cast("int"))
                    along = F.when(hp.bitwiseAND(row) != 0, 1).when(hn.bitwiseAND(row) != 0, -1).otherwise(0)
                    moved = F.when(j < rows - t, F.when(d0.bitwiseAND(n(low)) != 0, 0).otherwise(1)).otherwise(along)
                    vp = hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp))).bitwiseAND(n(mask))
                    return F.struct(vp.alias("vp"), down.bitwiseAND(hp).alias("vn"), (state["dist"] + moved).cast("int").alias("dist"))

                return let(d, with_diagonal)

            return F.when(state["dist"] > 3 * t, state).otherwise(let(same, with_match))

        start = F.struct(n(((1 << (t + 1)) - 1) << t).alias("vp"), n(0).alias("vn"), F.lit(t).alias("dist"))
        return F.aggregate(F.sequence(F.lit(0), s["columns"] - 1), start, step)["dist"]

    held = F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y"), F.length(a).alias("rows"), F.length(b).alias("columns"))
    return (F.abs(F.length(a) - F.length(b)) <= t) & (let(held, ran) <= t)


def _lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """doc, th (which tell a document's rows), pos and line of each line of at least least_chars characters that isn't blank."""
    hashed = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("th"), "text")  # once a text and not once a line
    placed = hashed.select("doc", "th", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return placed.filter((F.length("line") >= least_chars) & ((F.substring("line", 1, 1) > " ") | F.col("line").rlike(r"\S")))


#: A line's place. Documents with the same doc_id, or none, are told apart, and ordered, by th.
PLACE = ("doc", "pos", "th")


def _without(text: Column, removed: Column) -> Column:
    """text without the lines at the positions `removed` (null: none)."""
    def kept(s: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(s["lines"]) - 1), s["gone"])
        return F.array_join(F.transform(stay, lambda i: F.get(s["lines"], i)), "\n")

    # bound to a lambda's variable, the lines are split once and not once a line
    held = F.transform(F.array(F.struct(F.split(text, "\n").alias("lines"), removed.alias("gone"))), kept)
    return F.when(removed.isNull() | text.isNull(), text).otherwise(F.get(held, F.lit(0)))


def _drop_lines(docs: DataFrame, removed: DataFrame, count: str, limit: int = 0) -> DataFrame:
    """docs without the lines removed (doc, th, pos), with their number in column `count`; up to `limit` places are sent to all tasks."""
    gone = removed.groupBy(F.col("doc").alias("__doc"), F.col("th").alias("__th")).agg(F.collect_set("pos").alias("__gone"))
    if limit and removed.limit(limit + 1).count() <= limit:
        gone = F.broadcast(gone)
    keyed = docs.withColumn("__doc", F.coalesce("doc_id", F.lit(LAST))).withColumn("__th", F.xxhash64("text"))
    joined = keyed.join(gone, ["__doc", "__th"], "left")
    return joined.withColumn("text", _without(F.col("text"), F.col("__gone"))).withColumn(count, F.coalesce(F.size("__gone"), F.lit(0))).drop("__doc", "__th", "__gone")


def _live(lines: DataFrame, threshold: int) -> DataFrame:
    """key, own, id of the keyed rows whose key is stored by one line and met by another; lines: id (of 63 bits), line.

    The rows are dealt by key once, own as the last bit of the id; whether a key leads anywhere is decided where its rows lie.
    """
    rows = keyed(lines, threshold).select("key", F.shiftleft("id", 1).bitwiseOR(F.col("own").cast("long")).alias("held")).repartition("key")
    seen = rows.groupBy("key").agg(F.min("held").alias("low"), F.max("held").alias("high"), F.bit_or("held").alias("any"))
    met = seen.filter((F.shiftright("low", 1) < F.shiftright("high", 1)) & (F.col("any").bitwiseAND(F.lit(1)) == 1)).select("key")
    return rows.join(met.hint("shuffle_hash"), "key").select("key", (F.col("held").bitwiseAND(F.lit(1)) == 1).alias("own"), F.shiftright("held", 1).alias("id"))


def near_line_links(docs: DataFrame, threshold: int, least_chars: int) -> DataFrame:
    """Links (a, b) of places (structs of PLACE) that connect all near lines of docs, whose lines must be distinct.

    First every line is compared with one line that stores each of its keys, which joins most of a large group of near
    lines without its pairs; then with the lines of the same key that this hasn't connected it with.
    """
    lines = _lines(docs, least_chars).withColumn("id", F.shiftright(F.xxhash64("line"), 1))
    live = checkpoint(_live(lines.select("id", "line"), threshold).distinct())
    release(docs.sparkSession)
    ids = checkpoint(live.select("id").distinct())
    wanted = lines.join(sized(ids, 500_000), "id", "left_semi").select("id", "line", F.struct(*PLACE).alias("p")).dropDuplicates(["id", "p"])
    parts = [f"sig{i}" for i in range(PARTS)]
    wanted = checkpoint(wanted.withColumns({name: signature(F.col("line"), i) for i, name in enumerate(parts)}))
    keys = checkpoint(live.join(wanted.select("id", *parts).dropDuplicates(["id"]), "id"))
    may, gap = F.col("x.id") != F.col("y.id"), F.lit(0)
    for name in parts:
        gap = gap + signature_gap(F.col(f"x.{name}"), F.col(f"y.{name}"))
        may = may & (gap <= 2 * threshold)

    def near(x: DataFrame, y: DataFrame, on: Column) -> DataFrame:
        """a and b, the places of the lines of x and y that are near; candidates are compared once however many keys they share."""
        pairs = checkpoint(x.alias("x").join(y.alias("y"), on & may).select(F.least("x.id", "y.id").alias("id_a"), F.greatest("x.id", "y.id").alias("id_b")).distinct())
        side = lambda s: wanted.select(F.col("id").alias(f"id_{s}"), F.col("line").alias(f"line_{s}"), F.col("p").alias(s))
        both = pairs.join(side("a"), "id_a").join(side("b"), "id_b")
        return checkpoint(both.filter(within_edits(F.col("line_a"), F.col("line_b"), threshold)).select("id_a", "id_b", "a", "b"))

    centres = keys.filter("own").groupBy("key").agg(F.min_by(F.struct("id", *parts), F.xxhash64("id", "key")).alias("c")).select("key", "c.*")
    stars = near(keys, centres, F.col("x.key") == F.col("y.key"))
    roots = components(stars.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))).withColumnRenamed("node", "id")
    grouped = keys.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    several = grouped.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("key")
    grouped = checkpoint(grouped.join(several, "key", "left_semi"))
    across = near(grouped.filter("own"), grouped, (F.col("x.key") == F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & (~F.col("y.own") | (F.col("x.id") < F.col("y.id"))))
    return stars.unionByName(across).select("a", "b")


def _repeats(found: DataFrame, frequent: int = 10_000) -> DataFrame:
    """The places of found (doc, th, pos, h1, h2) that hold a line that an earlier place holds.

    Lines that make up more than 1 / `frequent` of all places are fewer than `frequent`: their first places are sent
    to all tasks, so that no task has to hold all places of a line.
    """
    first = checkpoint(found.groupBy("h1", "h2").agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    often = F.col("n") > found.count() / frequent
    hot = F.broadcast(first.filter(often).drop("n"))
    at = found.withColumn("at", F.struct(*PLACE))
    rest = at.join(hot.select("h1", "h2"), ["h1", "h2"], "left_anti").join(first.filter(~often).drop("n"), ["h1", "h2"])
    return at.join(hot, ["h1", "h2"]).unionByName(rest).filter("at <> first").select(*PLACE)


def dedup_lines(docs: DataFrame, threshold: int = 2, least_chars: int = 24, least_exact: int | None = None) -> DataFrame:
    """docs (doc_id, text, others) with repeated lines taken out, and n_lines, n_exact, n_near.

    Of equal lines, and of each class of near lines, the first by (doc_id, position) stays. Blank lines are left alone.
    Lines under least_chars characters have no near lines (threshold + 1 are needed for segments that aren't empty), and
    equal ones count from least_exact characters on, which is least_chars unless given and never more. Null and empty texts stay as
    they are; a null doc_id comes last, as the largest number does. Rows with the same doc_id and text are one document:
    what one loses, the other loses. Rows with the same doc_id, or none, and different texts are documents of their own,
    in the order of a hash of the text where doc_id and position agree. Other columns pass through, also n_lines' like,
    which are replaced.
    """
    docs = docs.drop("n_lines", "n_exact", "n_near")
    columns = docs.columns
    least_exact = least_chars if least_exact is None else min(least_exact, least_chars)
    found = written(_lines(docs.select("doc_id", "text"), least_exact).select(*PLACE, F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")), "lines")
    counted = docs.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)))
    once = written(_drop_lines(counted, _repeats(found), "n_exact"), "once")
    discard(found)
    del found, counted
    release(docs.sparkSession)
    links = checkpoint(near_line_links(once.select("doc_id", "text"), threshold, least_chars))
    near = checkpoint(components(links).filter("node <> root").select("node.*"))
    return _drop_lines(once, near, "n_near", limit=500_000).select(*columns, "n_lines", "n_exact", "n_near")


def dedup_all_lines(docs: DataFrame, threshold: int = 2) -> DataFrame:
    """dedup_lines for lines of any length: equal ones from one character on, near ones from the least that segments need."""
    return dedup_lines(docs, threshold, least_chars=threshold + 1, least_exact=1)


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with its remaining text and the numbers of lines it had and lost."""
    from .common import table

    out = dedup_all_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", F.col("n_lines").cast("long"), F.col("n_exact").cast("long"), F.col("n_near").cast("long"), "text")
