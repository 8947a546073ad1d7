"""Line deduplication by a segment-partition edit join, in DataFrame functions only.

Lines within ``THRESHOLD`` edits of each other share one of THRESHOLD + 1 segments.  Each distinct line is
indexed by its segments and probes the segments of lines as long as itself or a little shorter, with the
few substrings that a match allows; candidates are verified by a banded bit-parallel edit distance.
A line needs one earlier line near it, no list of them: where many lines share a segment they meet a few
early lines first, and only what these leave meets more of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_TABLE, discard, materialise

#: Edits that near lines differ by at most.
THRESHOLD = 2
#: Shorter lines are left alone: a few edits make another line of them.
MIN_CHARS = 32
#: What the whole rule allows of the shorter line's characters as edits (in per cent), where that is more than THRESHOLD.
PERCENT = 5
#: Long lines within PERCENT of each other share a run of GRAM + SPREAD - 1 characters, so a gram picked from it.
GRAM, SPREAD = 10, 6
#: Characters whose counts are compared before long lines are.
LETTERS = "etaoinsrhldumc"
#: Lines that share a segment beyond this number are joined with more conditions than the segment.
HOT_LINES = 24
#: Each round over crowded segments meets so many times the early lines of the round before.
GROWTH = 8
#: Pairs of lines that one task verifies.
PAIRS_A_TASK = 5_000
#: Lines of crowded segments and early lines that one task brings together.
MEETINGS_A_TASK = 4_000_000
#: Rows that meet one crowded segment's early lines are dealt over so many tasks.
SALTS = 8
#: A document is a near copy of one that had this share of its text before in whole lines, is as long but for
#: the similarity's part, and shares this much of its five-word shingles.
SHARED_TEXT, COPY_SIMILARITY, SHINGLE = 0.15, 0.8, 5
#: Keys (of 16 bytes) that are broadcast at most; more are joined by shuffling.
BROADCAST_KEYS = 200_000
#: Characters fall in 30 buckets; counts modulo 16 of 15 buckets fit a number.
BUCKETS, NIBBLES = 30, (1 << 60) - 1
#: Characters that are in no word.
_WORDLESS = "".join(chr(b) for b in range(128) if WORD_TABLE[b] == 32)


def _row_key(doc_id: str, text: str) -> tuple[Column, Column]:
    """What tells rows apart: rows with the same id and text have the same key."""
    return F.xxhash64(doc_id, text).alias("k1"), F.hash(text, doc_id).alias("k2")


def lines_of(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, short: bool = False) -> DataFrame:
    """k1, k2, doc_id, pos, line and its hashes h1, h2 for each line of at least ``min_chars`` code points.

    With ``short`` every shorter line that has a word comes too.
    """
    taken = F.length("line") >= min_chars
    if short:
        taken = taken | (F.translate("line", _WORDLESS, "") != "")
    return (
        docs.select(F.col(doc_id).alias("doc_id"), *_row_key(doc_id, text), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
        .where(taken)
        .select("k1", "k2", "doc_id", "pos", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))
    )


def _cuts(length: Column, tau: int) -> list[tuple[Column, Column]]:
    """Start (from 0) and length of each of the tau + 1 segments of a line; the last ones take the remainder."""
    n = tau + 1
    base, rest = F.floor(length / n).cast("int"), length % n
    out, at = [], F.lit(0)
    for i in range(n):
        size = base + (F.lit(i) >= F.lit(n) - rest).cast("int")
        out.append((at, size))
        at = at + size
    return out


def index_keys(line: Column, tau: int = THRESHOLD) -> list[Column]:
    """A hash for each segment, with its number and the line's length."""
    length = F.length(line)
    return [F.xxhash64(F.substring(line, start + 1, size), F.lit(i), length) for i, (start, size) in enumerate(_cuts(length, tau))]


def probe_keys(line: Column, tau: int = THRESHOLD) -> list[Column]:
    """Hashes of the substrings that can match a segment of a line up to ``tau`` shorter, but for its own segments.

    A match of segment i needs at most i edits before it and tau - i after it (else another segment
    matches too), which bounds how far its place can move from either end.
    """
    length = F.length(line)
    keys = []
    for less in range(tau + 1):
        other = length - less
        for i, (start, size) in enumerate(_cuts(other, tau)):
            low, high = max(-i, less - (tau - i)), min(i, less + (tau - i))
            keys += [F.xxhash64(F.substring(line, start + move + 1, size), F.lit(i), other) for move in range(low, high + 1) if less or move]
    return keys


def char_counts(line: Column) -> Column:
    """lo and hi: how often characters of each bucket occur, modulo 16, four bits each."""

    def add(acc: Column, c: Column) -> Column:
        code = F.ascii(c) % BUCKETS
        one = lambda low: F.when((code >= low) & (code < low + 15), F.call_function("shiftleft", F.lit(1).cast("long"), (code - low) * 4)).otherwise(F.lit(0).cast("long"))
        return F.struct((acc["lo"] + one(0)).bitwiseAND(NIBBLES).alias("lo"), (acc["hi"] + one(15)).bitwiseAND(NIBBLES).alias("hi"))

    zero = F.lit(0).cast("long")
    return F.aggregate(F.split(line, ""), F.struct(zero.alias("lo"), zero.alias("hi")), add)


def counts_apart(a: Column, b: Column) -> Column:
    """The sum of the differences of the counts, where small: an edit changes it by two at most.

    Sums of counts differ by the counts' differences, whose balanced digits are read off.
    """
    middle = int("8" * 15, 16)
    total = F.lit(0).cast("long")
    for part in ("lo", "hi"):
        moved = (a[part] - b[part] + middle).bitwiseAND(NIBBLES)
        total = total + sum((F.abs(F.shiftright(moved, 4 * k).bitwiseAND(15) - 8) for k in range(15)), F.lit(0).cast("long"))
    return total


def _ring(counts: Column) -> list[Column]:
    """Counts modulo 16 of the buckets of e, n and t."""
    out = []
    for c in "ent":
        part, k = ("lo", ord(c) % BUCKETS) if ord(c) % BUCKETS < 15 else ("hi", ord(c) % BUCKETS - 15)
        out.append(F.shiftright(counts[part], 4 * k).bitwiseAND(15).cast("int"))
    return out


def _cell(quarters: list[Column]) -> Column:
    return sum((q * 4**i for i, q in enumerate(quarters)), F.lit(0))


def index_cell(counts: Column) -> Column:
    """The cell of a line: the quarters of the ring of 16 that its three counts lie in."""
    return _cell([F.shiftright(v, 2) for v in _ring(counts)])


def probe_cells(counts: Column, tau: int) -> Column:
    """Cells that a line within ``tau`` edits may lie in: every quarter from each count - tau to count + tau."""
    # steps of a quarter's width miss none, and the end is one of them
    steps = sorted({*range(-tau, tau + 1, 4), tau})
    cells = F.array(F.lit(0))
    for i, v in enumerate(_ring(counts)):
        quarters = F.array_distinct(F.array(*[F.shiftright(F.pmod(v + d, F.lit(16)), 2) * 4**i for d in steps]))
        cells = _pairwise(cells, quarters)
    return cells


def _pairwise(cells: Column, quarters: Column) -> Column:
    return F.flatten(F.transform(cells, lambda c: F.transform(quarters, lambda q: c + q)))


def edit_distance(a: Column, b: Column, tau: int = THRESHOLD) -> Column:
    """Edit distance of two strings where it is at most ``tau``, some larger number elsewhere.

    Bit vectors of the 2 * tau + 1 rows around the diagonal hold the differences down a column of the
    dynamic programme (after Hyyro, 2003); a character moves the band by one row with a few word operations.
    """
    width = 2 * tau + 1
    mask = (1 << width) - 1
    n, m = F.length(b), F.length(a)
    pattern = F.concat(F.array_repeat(F.lit(""), tau), F.split(a, ""), F.array_repeat(F.lit(""), tau + 1))

    def column(p: Column, acc: Column, c: Column) -> Column:
        # bit k of the band is row j - tau + k, which is place j - 1 + k of the padded pattern
        j = acc["j"] + 1
        equal = F.lit(0)
        for k in range(width):
            equal = equal.bitwiseOR(F.when(F.get(p, acc["j"] + k) == c, 1 << k).otherwise(0))
        step = F.struct(j.alias("j"), equal.alias("x"), acc["vp"].alias("vp"), acc["vn"].alias("vn"), acc["d"].alias("d"))
        return _once(step, diagonal)

    def diagonal(s: Column) -> Column:
        x, vp, vn = s["x"], s["vp"], s["vn"]
        d0 = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(mask)
        return _once(F.struct(s["j"].alias("j"), vp.alias("vp"), vn.alias("vn"), s["d"].alias("d"), d0.alias("d0")), horizontal)

    def horizontal(s: Column) -> Column:
        d0, vp, vn = s["d0"], s["vp"], s["vn"]
        hp = vn.bitwiseOR(F.lit(mask).bitwiseXOR(d0.bitwiseOR(vp)))
        return _once(F.struct(s["j"].alias("j"), s["d"].alias("d"), d0.alias("d0"), hp.alias("hp"), d0.bitwiseAND(vp).alias("hn")), vertical)

    def vertical(s: Column) -> Column:
        d0, hp, hn, j = s["d0"], s["hp"], s["hn"], s["j"]
        down = F.shiftright(d0, 1)
        row = m - j + tau  # the last row's bit, once the band has reached it
        bit = lambda v: F.shiftright(v, 0).bitwiseAND(F.call_function("shiftleft", F.lit(1), row)) != 0
        along = F.when(bit(hp), 1).otherwise(0) - F.when(bit(hn), 1).otherwise(0)
        onward = F.when(row >= 2 * tau, 1 - F.shiftright(d0, 2 * tau)).otherwise(along)
        return F.struct(
            j.alias("j"),
            hn.bitwiseOR(F.lit(mask).bitwiseXOR(down.bitwiseOR(hp))).alias("vp"),
            down.bitwiseAND(hp).alias("vn"),
            (s["d"] + onward).alias("d"),
        )

    start = F.struct(F.lit(0).alias("j"), F.lit(mask & ~((1 << tau) - 1)).alias("vp"), F.lit(0).alias("vn"), F.lit(tau).alias("d"))
    # the pattern is bound once for the row; each step sees it as a variable
    whole = _once(pattern, lambda p: F.aggregate(F.split(b, ""), start, lambda acc, c: column(p, acc, c), lambda acc: acc["d"]))
    # an empty string would be split into one empty character
    return F.when(F.abs(n - m) > tau, tau + 1).when((n == 0) | (m == 0), n + m).otherwise(whole)


#: Steps by which the common start of two lines is found: a longer one is found in part, which is enough.
_STEPS = [1 << k for k in range(16, -1, -1)]


def _common(a: Column, b: Column) -> Column:
    """How many characters both start with, by doubling steps."""
    least = F.least(F.length(a), F.length(b))
    step = lambda n, p: n + F.when((n + p <= least) & (F.substring(a, n + 1, p) == F.substring(b, n + 1, p)), p).otherwise(0)
    return F.aggregate(F.array(*map(F.lit, _STEPS)), F.lit(0), step)


def differing(a: Column, b: Column) -> Column:
    """a and b without what both start and end with: their edit distance is that of the lines."""
    ends = lambda x: F.struct(F.reverse(x["a"]).alias("a"), F.reverse(x["b"]).alias("b"))
    cut = lambda x: _once(F.struct(x["a"], x["b"], _common(x["a"], x["b"]).alias("n")), lambda y: F.struct(*[F.substring(y[c], y["n"] + 1, F.length(y[c])).alias(c) for c in "ab"]))
    return _once(_once(F.struct(a.alias("a"), b.alias("b")), cut), lambda x: _once(ends(x), cut))


def _once(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _few(keys: DataFrame) -> DataFrame:
    """``keys`` marked for broadcasting if a count says that they are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _met(lines: DataFrame, tau: int) -> tuple[DataFrame, DataFrame]:
    """(a, b): pairs that share a segment of few lines; (h1, key, role): lines of segments of more than HOT_LINES."""
    line, n_index = F.col("line"), tau + 1
    keys = [*index_keys(line, tau), *probe_keys(line, tau)]
    names = [f"key{i}" for i in range(len(keys))]
    # single numbers, not arrays: they are gathered by hashing
    firsts = lines.select("h1", "h2", *[k.alias(n) for k, n in zip(keys, names, strict=True)]).groupBy("h1", "h2").agg(*[F.first(n).alias(n) for n in names])
    distinct = materialise(firsts.drop("h2"), "line-keys")
    index = distinct.select(F.explode(F.array(*names[:n_index])).alias("key"), F.col("h1").alias("b"))
    probe = distinct.select(F.explode(F.array(*names)).alias("key"), F.col("h1").alias("a"))
    hot = materialise(index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT_LINES).select("key"), "line-hot")
    few = _few(hot)
    cold = lambda side: side.join(few, "key", "left_anti")
    pairs = cold(probe).join(cold(index), "key").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = materialise(pairs, "line-pairs")
    role = lambda side, c, r: side.join(few, "key", "left_semi").select(F.col(c).alias("h1"), "key", F.lit(r).alias("role"))
    crowd = materialise(role(index, "b", "index").unionByName(role(probe, "a", "probe")).distinct(), "line-crowd")
    discard(distinct, hot)
    return pairs, crowd


def near_lines(lines: DataFrame, firsts: DataFrame, fetch: Callable[[DataFrame], DataFrame], *, tau: int = THRESHOLD) -> DataFrame:
    """Hashes (h1, h2) of lines that have an earlier different line at most ``tau`` edits away, each once.

    ``lines`` has line, h1 and h2, as often as they occur; ``firsts`` has the first place of each h1;
    ``fetch`` gives h1, h2 and line for a table of h1.  Lines that share a segment are compared if their
    counts of characters are close.  Where more than HOT_LINES lines share one, they lie in cells of
    their counts: each line first meets the earliest line of each cell near its own, then the earliest of
    GROWTH parts of the cell, of GROWTH ** 2 parts and so on, and only lines that are still without a near one go
    on; the last round has all lines of the cell.  So a crowd of near lines is settled by a few comparisons
    a line, and none is left out of one whose lines are far from each other.
    """
    if tau > 7:
        raise ValueError("character counts tell at most 7 edits apart")
    pairs, crowd = _met(lines, tau)
    wanted = materialise(pairs.select(F.explode(F.array("a", "b")).alias("h1")).unionByName(crowd.select("h1")).distinct(), "line-candidates")
    texts = fetch(wanted).groupBy("h1", "h2").agg(F.any_value("line").alias("line")).withColumn("counts", char_counts(F.col("line")))
    texts = materialise(texts.join(firsts, "h1"), "line-texts")
    side = lambda c: texts.select(F.col("h1").alias(c), F.struct("h2", "line", "counts", "first").alias(f"of_{c}"))
    close = lambda a, b: counts_apart(a, b) <= 2 * tau

    def near(met: DataFrame) -> DataFrame:
        both = met.join(side("a"), "a").join(side("b"), "b").where(close(F.col("of_a.counts"), F.col("of_b.counts")))
        later = F.when(F.col("of_a.first") < F.col("of_b.first"), F.struct(F.col("b").alias("h1"), "of_b.h2")).otherwise(F.struct(F.col("a").alias("h1"), "of_a.h2"))
        # few bytes are much work here, so the number of pairs says how many tasks there are
        dealt = both.select(later.alias("l"), differing(F.col("of_a.line"), F.col("of_b.line")).alias("d")).repartition(met.count() // PAIRS_A_TASK + 1)
        return materialise(dealt.where(edit_distance(F.col("d.a"), F.col("d.b"), tau) <= tau).select("l.h1", "l.h2").distinct(), "line-near")

    found = near(pairs)
    placed = crowd.join(texts.select("h1", "first", "counts"), "h1")
    at = {"index": F.array(index_cell(F.col("counts"))), "probe": probe_cells(F.col("counts"), tau)}
    cells = F.when(F.col("role") == "index", at["index"]).otherwise(at["probe"])
    crowd_cells = materialise(placed.select("role", "key", "h1", "first", "counts", F.explode(cells).alias("cell")), "line-cells")
    sizes = crowd_cells.groupBy("role", "key", "cell").agg(F.count("*").alias("n"))
    most, rows = sizes.agg(F.max("n"), F.sum("n")).first()
    most = most or 0
    settled, parts, nears = found.select("h1"), 1, [found]
    while most and not crowd_cells.join(settled, "h1", "left_anti").isEmpty():
        last = parts * GROWTH >= most
        tasks = rows * min(parts if not last else most, most) // MEETINGS_A_TASK + 1
        met = [_led(crowd_cells, settled, mine, theirs, None if last else parts, tasks, close) for mine, theirs in (("probe", "index"), ("index", "probe"))]
        met = materialise(met[0].unionByName(met[1]).distinct(), "line-led")
        more = near(met)
        discard(met)
        nears.append(more)
        found = found.unionByName(more)
        settled = settled.unionByName(more.select("h1"))
        if last:
            break
        parts *= GROWTH
    found = materialise(found.distinct(), "near-lines")
    discard(pairs, crowd, wanted, texts, crowd_cells, *nears)
    return found


def _led(crowd: DataFrame, settled: DataFrame, mine: str, theirs: str, parts: int | None, tasks: int, close) -> DataFrame:
    """(a, b): lines in one role that aren't settled, and the earliest lines before them in the other role of each of ``parts`` of a cell (all if None)."""
    me = crowd.where(F.col("role") == mine).join(settled, "h1", "left_anti").withColumn("salt", F.pmod("h1", F.lit(SALTS)).cast("int"))
    they = crowd.where(F.col("role") == theirs).select("key", "cell", F.struct("first", "h1", "counts").alias("lead"))
    if parts:
        part = F.pmod(F.xxhash64("lead.h1", F.lit("part")), F.lit(parts))
        they = they.groupBy("key", "cell", part.alias("part")).agg(F.min("lead").alias("lead"))
    they = they.select("key", "cell", "lead", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt"))
    me, they = (x.repartition(tasks, "key", "cell", "salt") for x in (me, they))
    here = me.join(they, ["key", "cell", "salt"]).where((F.col("lead.first") < F.col("first")) & (F.col("lead.h1") != F.col("h1")) & close(F.col("counts"), F.col("lead.counts")))
    return here.select(F.col("h1").alias("a"), F.col("lead.h1").alias("b"))


def picked_grams(line: Column) -> Column:
    """(key, at) of the least of each SPREAD neighbouring grams: lines that share GRAM + SPREAD - 1 characters share one."""
    chars = F.split(line, "")
    gram = lambda c, i: F.struct(F.xxhash64(F.slice(c, i, GRAM)).alias("key"), i.alias("at"))
    grams = _once(chars, lambda c: F.transform(F.sequence(F.lit(1), F.size(c) - GRAM + 1), lambda i: gram(c, i)))
    least = _once(grams, lambda g: F.transform(F.sequence(F.lit(1), F.size(g) - SPREAD + 1), lambda i: F.array_min(F.slice(g, i, SPREAD))))
    # the same gram is picked by neighbours only
    return _once(least, lambda m: F.filter(m, lambda x, i: (i == 0) | (x["at"] != F.get(m, i - 1)["at"])))


def letter_counts(line: Column) -> list[Column]:
    """How often each of LETTERS occurs, up to 255, seven to a number."""
    count = lambda c: F.least(F.lit(255), F.length(line) - F.length(F.replace(line, F.lit(c), F.lit("")))).cast("long")
    return [sum((F.shiftleft(count(c), 8 * k) for k, c in enumerate(LETTERS[i : i + 7])), F.lit(0).cast("long")) for i in (0, 7)]


def _letters_apart(pairs: list[tuple[Column, Column]]) -> Column:
    byte = lambda v, k: F.shiftright(v, 8 * k).bitwiseAND(255)
    return sum((F.abs(byte(a, k) - byte(b, k)) for a, b in pairs for k in range(7)), F.lit(0).cast("long"))


def grown_repeats(lines: DataFrame, firsts: DataFrame, fetch: Callable[[DataFrame], DataFrame], *, tau: int = THRESHOLD, percent: int = PERCENT) -> DataFrame:
    """Hashes h1 of long lines with an earlier line within ``percent`` of the shorter one's characters as edits.

    Long are lines of which ``percent`` is more than ``tau``; ``firsts`` has the first place of each h1.  Cut
    into one part more than there may be edits, the shorter line has a part that stands in the other too, and
    a picked gram in it.  Lines first meet the earliest line with their gram and length; those that are near
    it are settled, and only the others meet every earlier line of a like length, place and count of letters.
    """
    least = _grown_from(tau, percent)
    if min(n // (n * percent // 100 + 1) for n in range(least, 100 * least)) < GRAM + SPREAD - 1:
        raise ValueError("parts of so many edits are shorter than the grams picked from them")
    line = F.col("line")
    n, (c1, c2) = F.length(line), letter_counts(line)
    made = lines.where(n >= least).select("h1", n.alias("n"), c1.alias("c1"), c2.alias("c2"), picked_grams(line).alias("grams"))
    distinct = made.groupBy("h1").agg(*[F.first(c).alias(c) for c in ("n", "c1", "c2", "grams")]).join(firsts, "h1")
    level = F.floor(F.log("n") / F.log(F.lit(1 + percent / 100))).cast("int")
    spread = distinct.select("h1", "n", "c1", "c2", "first", level.alias("level"), F.inline("grams"))
    spread = materialise(spread, "line-spread")
    shared = spread.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low < high").select("key")
    grams = materialise(spread.join(shared, "key"), "line-grams")

    most = lambda a, b: F.floor(F.least(a, b) * percent / 100)
    alike = lambda a, b: (F.abs(a["n"] - b["n"]) <= most(a["n"], b["n"])) & (_letters_apart([(a["c1"], b["c1"]), (a["c2"], b["c2"])]) <= 2 * most(a["n"], b["n"]))

    def near(pairs: DataFrame, name: str) -> DataFrame:
        pairs = materialise(pairs.distinct(), name)
        wanted = materialise(pairs.select(F.explode(F.array("later", "earlier")).alias("h1")).distinct(), f"{name}-lines")
        texts = materialise(fetch(wanted).groupBy("h1").agg(F.any_value("line").alias("line")), f"{name}-texts")
        side = lambda c: texts.select(F.col("h1").alias(c), F.col("line").alias(f"line_{c}"))
        both = pairs.join(side("later"), "later").join(side("earlier"), "earlier")
        a, b = F.col("line_later"), F.col("line_earlier")
        limit = most(F.length(a), F.length(b)).cast("int")
        return materialise(both.where(F.call_function("levenshtein", a, b, limit) >= 0).select(F.col("later").alias("h1")).distinct(), f"{name}-near")

    me = F.struct("first", "h1", "n", "c1", "c2").alias("me")
    leaders = grams.groupBy("key", "level").agg(F.min(me).alias("leader"))
    led = grams.join(leaders, ["key", "level"]).select("h1", me, "leader").where("leader.first < me.first").where(alike(F.col("me"), F.col("leader")))
    settled = near(led.select(F.col("h1").alias("later"), F.col("leader.h1").alias("earlier")), "line-leaders")
    open_ = grams.join(settled, "h1", "left_anti").withColumn("level", F.explode(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1)))
    x, y = open_.select("key", "level", F.struct("first", "h1", "n", "c1", "c2", "at").alias("x")), grams.select("key", "level", F.struct("first", "h1", "n", "c1", "c2", "at").alias("y"))
    here = F.abs(F.col("x.at") - F.col("y.at")) <= most(F.col("x.n"), F.col("y.n"))
    met = x.alias("l").join(y.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.level") == F.col("r.level")) & (F.col("y.first") < F.col("x.first")) & here & alike(F.col("x"), F.col("y")))
    return settled.unionByName(near(met.select(F.col("x.h1").alias("later"), F.col("y.h1").alias("earlier")), "line-others"))


def _grown_from(tau: int, percent: int) -> int:
    """The least length of which ``percent`` is more than ``tau`` edits."""
    return -(-100 * (tau + 1) // percent)


def _shingles(text: Column) -> Column:
    """Hashes of the different runs of SHINGLE words; fewer words are one run."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _WORDLESS, "abcdefghijklmnopqrstuvwxyz" + " " * len(_WORDLESS))
    words = F.filter(F.split(low, " "), lambda w: w != "")
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - SHINGLE + 1)), lambda i: F.xxhash64(F.slice(w, i, SHINGLE)))
    return F.array_distinct(_once(words, runs))


def near_copies(docs: DataFrame, repeated: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(k1, k2, g1, g2): rows that are near copies of an earlier one (g), found by the lines that it had first.

    ``repeated`` has k1 and k2 of a row, those of the first row with a line of it as o1 and o2, and the
    line's length n.  A row is compared with the one that had most of its text before, if that is SHARED_TEXT of it.
    """
    owned = repeated.where("k1 <> o1 OR k2 <> o2").groupBy("k1", "k2", "o1", "o2").agg(F.sum("n").alias("n"))
    best = owned.groupBy("k1", "k2").agg(F.max(F.struct("n", "o1", "o2")).alias("best")).select("k1", "k2", F.col("best.n").alias("n"), F.col("best.o1").alias("o1"), F.col("best.o2").alias("o2"))
    sized = docs.select(*_row_key(doc_id, text), F.length(text).alias("size")).dropDuplicates(["k1", "k2"])
    mine = best.join(sized, ["k1", "k2"]).where(F.col("n") >= SHARED_TEXT * F.col("size"))
    theirs = sized.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("size").alias("other"))
    alike = F.least("size", "other") >= COPY_SIMILARITY * F.greatest("size", "other")
    pairs = materialise(mine.join(theirs, ["o1", "o2"]).where(alike).select("k1", "k2", "o1", "o2"), "copy-pairs")
    wanted = pairs.select("k1", "k2").unionByName(pairs.select(F.col("o1").alias("k1"), F.col("o2").alias("k2"))).distinct()
    keyed = docs.select(*_row_key(doc_id, text), F.col(text).alias("text")).join(_few(wanted), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    bags = materialise(keyed.select("k1", "k2", _shingles(F.col("text")).alias("bag")), "copy-bags")
    both = pairs.join(bags, ["k1", "k2"]).join(bags.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("bag").alias("other")), ["o1", "o2"])
    common = F.size(F.array_intersect("bag", "other"))
    same = common >= COPY_SIMILARITY * (F.size("bag") + F.size("other") - common)
    found = materialise(both.where(same).select("k1", "k2", F.col("o1").alias("g1"), F.col("o2").alias("g2")), "copies")
    discard(pairs, bags)
    return found


def duplicate_lines(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tau: int = THRESHOLD, min_chars: int = MIN_CHARS, short: bool = True, percent: int = 0, spare_copies: bool = False
) -> DataFrame:
    """k1, k2, doc_id, pos and kind ("exact" or "near") of each line that repeats an earlier one.

    Lines are ordered by the document's id and their place in it.  A line goes if the same line comes
    earlier, or if the first of its kind has an earlier different line within ``tau`` edits, or within
    ``percent`` of the shorter line's characters where that is more.  With ``short``, lines below
    ``min_chars`` that have a word go if they are repeated exactly.

    With ``spare_copies`` whole documents that are near copies are left to the operator for these: what a
    line's first document and its near copies share stays in all of them, and goes everywhere else.
    Repeats within a document go, and so do near lines but those first seen in a near copy.
    """
    lines = lines_of(docs, doc_id=doc_id, text=text, min_chars=min_chars, short=short)
    where = F.struct("doc_id", "k1", "k2", "pos")
    places = materialise(lines.select("k1", "k2", "doc_id", "pos", F.length("line").alias("n"), "h1", "h2"), "lines")
    classes = materialise(places.groupBy("h1", "h2").agg(F.min(where).alias("first")), "line-classes")

    def fetch(wanted: DataFrame) -> DataFrame:
        # only documents with the first of such a line are split again
        spots = materialise(classes.join(_few(wanted), "h1").select("first.k1", "first.k2").distinct(), "line-spots")
        k1, k2 = _row_key(doc_id, text)
        keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), k1, k2).join(_few(spots), ["k1", "k2"], "left_semi")
        return lines_of(keyed, min_chars=min_chars).join(_few(wanted), "h1", "left_semi").select("h1", "h2", "line")

    compared = lines.where(F.length("line") >= min_chars).select("h1", "h2", "line")
    # the shorter line sets the threshold, so ``tau`` holds for pairs of which it is below the length that grown ones start from
    few_edits = compared.where(F.length("line") < _grown_from(tau, percent) + tau) if percent else compared
    first = classes.groupBy("h1").agg(F.min("first").alias("first"))
    near = near_lines(few_edits, first, fetch, tau=tau)
    if percent:
        grown = grown_repeats(compared, first, fetch, tau=tau, percent=percent)
        near = near.unionByName(grown.join(classes, "h1").select("h1", "h2"))
    marked = classes.join(near.distinct().withColumn("near", F.lit(True)), ["h1", "h2"], "left")
    kind = F.when(F.col("first") != where, "exact").when(F.col("near"), "near")
    gone = places.join(marked, ["h1", "h2"]).withColumn("kind", kind).where("kind IS NOT NULL")
    if spare_copies:
        gone = _sparing(docs, gone, doc_id, text, (places, classes))
    return gone.select("k1", "k2", "doc_id", "pos", "kind").distinct()


def _sparing(docs: DataFrame, gone: DataFrame, doc_id: str, text: str, read: tuple[DataFrame, ...]) -> DataFrame:
    """``gone`` without the lines that near copies have in common with the first of them; ``read`` are tables behind it."""
    gone = materialise(gone.select("k1", "k2", "doc_id", "pos", "n", "h1", "h2", "near", "kind", F.col("first.k1").alias("o1"), F.col("first.k2").alias("o2")), "line-gone")
    discard(*read)
    copies = near_copies(docs, gone.where("kind = 'exact'"), doc_id=doc_id, text=text)
    few = _few(copies)
    of_first = few.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("g1").alias("f1"), F.col("g2").alias("f2"))
    grouped = gone.join(few, ["k1", "k2"], "left").join(of_first, ["o1", "o2"], "left")
    inside = (F.coalesce("g1", "k1") == F.coalesce("f1", "o1")) & (F.coalesce("g2", "k2") == F.coalesce("f2", "o2"))
    elsewhere = (F.col("k1") != F.col("o1")) | (F.col("k2") != F.col("o2"))
    near = F.coalesce("near", F.lit(False)) & F.col("f1").isNull()
    spared = inside & ((elsewhere & ~near) | ((F.col("kind") == "near") & ~near))
    flagged = materialise(grouped.select("k1", "k2", "doc_id", "pos", "h1", "h2", "kind", spared.alias("spared")), "line-flagged")
    discard(gone, copies)
    # a line that a near copy has several times stays at the first place
    kept = flagged.where("spared").groupBy("k1", "k2", "h1", "h2").agg(F.min("pos").alias("pos"))
    return flagged.join(kept.select("k1", "k2", "pos"), ["k1", "k2", "pos"], "left_anti")


def dedup_lines(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tau: int = THRESHOLD, min_chars: int = MIN_CHARS, short: bool = True, percent: int = 0, spare_copies: bool = False
) -> DataFrame:
    """``docs`` without repeated lines in ``text``, with n_lines, n_exact and n_near (lines removed).

    Lines of at least ``min_chars`` code points are compared by edits, with ``short`` others with a word for equality;
    ``percent`` lets the edits grow with the lines, ``spare_copies`` leaves near copies of whole documents
    alone (see duplicate_lines).  Defined cases: a null text stays null with no lines, an empty one has one
    empty line; rows with the same id and text are one document to the comparison and keep the same lines;
    a document may end up empty; a very long line is compared whole, a very long text line by line; of lines
    with equal places none exists, so ties can't arise; an empty table gives an empty result; other columns
    are carried, those named like a new one replaced.
    """
    gone = duplicate_lines(docs, doc_id=doc_id, text=text, tau=tau, min_chars=min_chars, short=short, percent=percent, spare_copies=spare_copies)
    by_doc = gone.groupBy("k1", "k2").agg(
        F.collect_list("pos").alias("gone"), F.count_if(F.col("kind") == "exact").alias("exact"), F.count_if(F.col("kind") == "near").alias("near")
    )
    # the row travels as one value, so that no column of it can clash
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    joined = docs.select(row, *_row_key(doc_id, text)).join(by_doc, ["k1", "k2"], "left")
    body = F.col("row")[text]
    lines = F.split(body, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone")
    rest = _once(lines, lambda parts: F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n"))
    new = {
        "n_lines": F.when(body.isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "n_exact": F.coalesce("exact", F.lit(0)).cast("long"),
        "n_near": F.coalesce("near", F.lit(0)).cast("long"),
    }
    old = {c: F.when(F.col("gone").isNull(), body).otherwise(rest) if c == text else F.col("row")[c] for c in docs.columns if c not in new}
    return joined.select(*[v.alias(n) for n, v in (old | new).items()])


def line_report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tau: int = THRESHOLD, min_chars: int = MIN_CHARS, short: bool = True, percent: int = 0) -> DataFrame:
    """doc_id, n_lines, n_exact, n_near and removed (sorted places of the removed lines) of each document."""
    gone = duplicate_lines(docs, doc_id=doc_id, text=text, tau=tau, min_chars=min_chars, short=short, percent=percent)
    by_doc = gone.groupBy("k1", "k2").agg(
        F.sort_array(F.collect_list("pos")).alias("removed"), F.count_if(F.col("kind") == "exact").alias("n_exact"), F.count_if(F.col("kind") == "near").alias("n_near")
    )
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1)
    all_docs = docs.select(F.col(doc_id).alias("doc_id"), *_row_key(doc_id, text), n_lines.cast("long").alias("n_lines"))
    none = F.lit(0).cast("long")
    return all_docs.join(by_doc, ["k1", "k2"], "left").select(
        "doc_id", "n_lines", F.coalesce("n_exact", none).alias("n_exact"), F.coalesce("n_near", none).alias("n_near"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed")
    )
