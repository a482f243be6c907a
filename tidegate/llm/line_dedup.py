"""Line dedup by a segment-partition edit join.

A line repeats an earlier one when both are equal, or when both are long and at most ``EDITS`` edits apart; of each class
of such lines the occurrence with the smallest (id, line number) stays. Long lines are cut into ``EDITS + 1`` disjoint
segments: two edits leave one of three untouched, the first at the start, the last at the end, the middle one shifted by
one character at most. The segments of a line are probed with its length range as part of the key, lines that share one
and are nearly as long are candidates, and a banded bit-parallel edit distance decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bounded, stage, text_of
from .graph import components

EDITS = 2
#: Lines of fewer code points repeat another only when equal to it.
LONG_LINE = 48
#: A segment has a third of this many characters for each whole such stretch of the line.
STRETCH = 24
#: Different lines with one segment in common from which on the rest of the line is cut into segments again.
CROWD = 128
_THIRD = STRETCH // (EDITS + 1)


def _sorted_lines(text: Column) -> Column:
    """The non-blank lines of a text with their positions from 0, sorted."""
    lines = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(x.alias("line"), i.alias("at")))
    return F.sort_array(F.filter(lines, lambda p: p["line"].rlike(f"[^{SPACE}]")))


def _occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text_key`` and each different line of the text: ``line``, ``at``, ``key`` (128-bit digest) and ``k`` (64 bits)."""
    text = text_of(text_col)
    ordered = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("text_key"), _sorted_lines(text).alias("s"))
    firsts = F.expr("filter(s, (p, j) -> j = 0 or p.line <> s[j - 1].line)")
    out = ordered.select("id", "text_key", F.explode(firsts).alias("p")).select("id", "text_key", "p.line", "p.at")
    return out.withColumn("key", F.unhex(F.md5(F.col("line").cast("binary")))).withColumn("k", F.xxhash64("line"))


def _segment_keys(line: str, size: str, under: str = "0L") -> str:
    """SQL of the hashes of a line's segments for its own range of lengths, and for the next shorter range where a partner may be in it."""

    def of(q: str) -> str:
        n = f"{_THIRD} * {q}"
        middle = ", ".join(f"xxhash64({under}, {q}, 2, substring({line}, {n} + {1 + shift}, {n}))" for shift in (-1, 0, 1))
        return f"array(xxhash64({under}, {q}, 1, substring({line}, 1, {n})), {middle}, xxhash64({under}, {q}, 3, right({line}, {n})))"

    own, less = f"({size} div {STRETCH})", f"(({size} - {EDITS}) div {STRETCH})"
    return f"array_distinct(if({less} < {own} and {less} > 0, concat({of(own)}, {of(less)}), {of(own)}))"


def _rest_keys() -> str:
    """SQL of the segments of what a line has besides its segment ``h``: a pair that leaves ``h`` untouched has its edits there."""
    cuts = []
    for q in (f"(size div {STRETCH})", f"((size - {EDITS}) div {STRETCH})"):
        n = f"{_THIRD} * {q}"
        for part, start in ((1, "1"), (2, f"{n}"), (2, f"({n} + 1)"), (2, f"({n} + 2)"), (3, f"(size - {n} + 1)")):
            own, rest = f"xxhash64(0L, {q}, {part}, substring(line, {start}, {n}))", f"concat(substring(line, 1, {start} - 1), substring(line, {start} + {n}))"
            cuts.append(f"if({q} > 0 and {own} = h, {rest}, null)")
    return f"flatten(transform(array(coalesce({', '.join(cuts)}, line)), r -> {_segment_keys('r', 'length(r)', 'h')}))"


def within(a: str, b: str, edits: int = EDITS) -> Column:
    """Whether two lines (columns ``a`` and ``b``, the shorter) are at most ``edits`` edits apart.

    Bit-parallel, in a band: bit ``t`` of a column's words stands for the row ``edits - t`` above to ``edits`` below the
    diagonal. The distance is followed down the band's lower edge and, past the end of ``a``, along its last row. Each
    ``transform(array(..), v -> ..)[0]`` names a value that is computed once.
    """
    top, whole = 2 * edits, (1 << (2 * edits + 1)) - 1
    same = " | ".join(f"if(get(p.x, s.i + {t - edits}) <=> c, {1 << t}, 0)" for t in range(top + 1))
    # past the end of a, its last row lies on this bit of the column
    end = f"shiftleft(1, size(p.x) - 1 - v.i + {edits})"
    return F.expr(f"""
        transform(array(struct(split({a}, '') as x, split({b}, '') as y)), p ->
        aggregate(p.y, struct({whole & ~((1 << edits) - 1)} as vp, 0 as vn, {edits} as d, 0 as i), (s, c) ->
            transform(array(struct(s.vp as vp, s.vn as vn, s.d as d, s.i as i, ({same}) as m)), r ->
            transform(array(struct(r.vp as vp, r.vn as vn, r.d as d, r.i as i, ((((r.m & r.vp) + r.vp) ^ r.vp | r.m | r.vn) & {whole}) as d0)), u ->
            transform(array(struct(u.d0 as d0, u.d as d, u.i as i, ((u.vn | ~(u.d0 | u.vp)) & {whole}) as hp, (u.d0 & u.vp) as hn)), v ->
            struct(
                ((v.hn | ~(shiftright(v.d0, 1) | v.hp)) & {whole}) as vp,
                (shiftright(v.d0, 1) & v.hp) as vn,
                (case when v.i + {edits} < size(p.x) then v.d + if((v.d0 & {1 << top}) = 0, 1, 0)
                      else v.d + if((v.hp & {end}) <> 0, 1, 0) - if((v.hn & {end}) <> 0, 1, 0) end) as d,
                v.i + 1 as i))[0])[0])[0], s -> s.d <= {edits}))[0]""")


def _parity() -> Column:
    """Twice 64 bits of a line: the parities of how often each class of characters, and of neighbours, occurs.

    An edit turns two of the first and four of the second at most.
    """
    return F.expr("""
        aggregate(split(line, ''), struct(0L as one, 0L as two, '' as before), (s, c) -> struct(
            s.one ^ shiftleft(1L, pmod(ascii(c), 64)) as one,
            s.two ^ shiftleft(1L, cast(pmod(xxhash64(s.before, c), 64) as int)) as two,
            c as before), s -> struct(s.one as one, s.two as two))""")


def _turned(part: str) -> Column:
    return F.bit_count(F.col(f"parity.{part}").bitwiseXOR(F.col(f"other_parity.{part}")))


def _pairs(members: DataFrame) -> DataFrame:
    """Pairs of different lines with a segment key in common whose lengths and parities allow for the edits."""
    left, right = members.select("h", "k", "size", "parity"), members.select("h", *(F.col(c).alias(f"other_{c}") for c in ("k", "size", "parity")))
    near = (F.abs(F.col("size") - F.col("other_size")) <= EDITS) & (_turned("one") <= 2 * EDITS) & (_turned("two") <= 4 * EDITS)
    return left.join(right, (left["h"] == right["h"]) & (F.col("k") < F.col("other_k")) & near).select("k", F.col("other_k").alias("other")).distinct()


def _alike(pieces: int = 8) -> Column:
    """Of lines ``x`` and ``y``, the shorter: all pieces of ``y`` but one per edit stand in ``x`` within the edits of their place."""
    width = f"(length(y) div {pieces})"
    found = [f"if(locate(substring(y, {i} * {width} + 1, {width}), substring(x, greatest(1, {i} * {width} + {1 - EDITS}), {width} + {2 * EDITS})) > 0, 1, 0)" for i in range(pieces)]
    return F.expr(f"{' + '.join(found)} >= {pieces - EDITS}")


def _links(occurrences: DataFrame) -> DataFrame:
    """Verified links between different long lines: ``a``, ``b`` (64-bit line hashes)."""
    long = occurrences.select("k", "line", F.length("line").alias("size")).filter(F.col("size") >= LONG_LINE)
    segments = stage(long.select("k", "size", F.expr(f"explode({_segment_keys('line', 'size')})").alias("h")), "line-segments")
    shared = segments.groupBy("h").agg(F.min("k").alias("low"), F.max("k").alias("high")).filter("low < high").select("h")
    members = stage(segments.join(bounded(stage(shared, "line-shared")), "h").distinct(), "line-members")
    texts = long.join(bounded(stage(members.select("k").distinct(), "line-candidates")), "k").distinct()
    texts = stage(texts.withColumn("parity", _parity()), "line-texts")
    crowds = stage(members.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select("h", F.lit(True).alias("crowd")), "line-crowds")
    told = members.join(crowds, "h", "left")
    apart = told.filter("crowd is null").select("h", "k").join(texts.select("k", "size", "parity"), "k")
    again = told.filter("crowd").select("h", "k").join(texts, "k")
    again = stage(again.select("k", "size", "parity", F.expr(f"explode({_rest_keys()})").alias("h")).distinct(), "line-crowd-members")
    candidates = stage(_pairs(apart).unionAll(_pairs(again)).distinct(), "line-pairs")
    lines = texts.select("k", "line")
    both = candidates.join(lines.withColumnRenamed("line", "p"), "k").join(lines.select(F.col("k").alias("other"), F.col("line").alias("q")), "other")
    longer, shorter = F.when(F.length("p") >= F.length("q"), F.col("p")).otherwise(F.col("q")), F.when(F.length("p") >= F.length("q"), F.col("q")).otherwise(F.col("p"))
    alike = both.select("k", "other", longer.alias("x"), shorter.alias("y")).filter(_alike())
    verified = alike.filter(within("x", "y"))
    return stage(verified.select(F.col("k").alias("a"), F.col("other").alias("b")), "line-links")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, the text without its repeating lines, and ``n_lines`` (non-blank), ``n_removed``, ``n_near`` (of
    them, those that equal no earlier line) and ``n_links`` (links of its lines to different lines).

    Columns of those names are replaced. Blank lines stay; a null text stays null and an empty one empty; null ids come
    last in the order; of rows with the same id neither is earlier, but lines repeated within a text go; an empty table
    gives no rows.
    """
    text, big = text_of(text_col), F.lit(2**63 - 1)
    found = _occurrences(docs, id_col, text_col)
    narrow = stage(found.select(F.coalesce(F.col("id").cast("long"), big).alias("rank"), "text_key", "at", "key", "k"), "line-occurrences")
    links = _links(found)
    label = stage(components(links), "line-classes")
    degree = links.select("a").unionAll(links.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("k")).agg(F.count("*").alias("links"))
    earliest = narrow.groupBy("key", "k").agg(F.min("rank").alias("first"))
    earliest = earliest.join(bounded(label.select(F.col("node").alias("k"), "label")), "k", "left")
    linked = narrow.join(bounded(label.select(F.col("node").alias("k"), "label")), "k")
    start = linked.groupBy("label").agg(F.min(F.struct("rank", "at")).alias("s")).select("label", F.col("s.rank").alias("class_rank"), F.col("s.at").alias("class_at"))
    lines = narrow.join(earliest.select("key", "first", "label"), "key").join(bounded(stage(start, "line-class-starts")), "label", "left")
    lines = lines.join(bounded(stage(degree, "line-degrees")), "k", "left")
    exact = F.col("rank") > F.col("first")
    near = F.col("label").isNotNull() & ((F.col("rank") > F.col("class_rank")) | (F.col("rank") == F.col("class_rank")) & (F.col("at") > F.col("class_at")))
    judged = lines.withColumn("exact", exact).withColumn("near", ~exact & F.coalesce(near, F.lit(False)))
    verdict = judged.groupBy("rank", "text_key").agg(
        F.array_distinct(F.collect_list(F.when(F.col("exact") | F.col("near"), F.col("at")))).alias("__gone"),
        F.array_size(F.array_distinct(F.collect_list(F.when(F.col("near"), F.col("at"))))).cast("long").alias("__near"),
        F.array_distinct(F.collect_list(F.when(F.col("links").isNotNull(), F.struct("at", "links")))).alias("__links"),
    )
    verdict = stage(verdict.filter("size(__gone) > 0 or size(__links) > 0"), "line-verdicts")
    others = [c for c in docs.columns if c not in (text_col, "n_lines", "n_removed", "n_near", "n_links")]
    keyed = docs.select(
        *(F.col(f"`{c}`") for c in others), F.col(text_col).alias("__text"),
        F.coalesce(F.col(id_col).cast("long"), big).alias("__rank"), F.unhex(F.md5(text.cast("binary"))).alias("__key"),
    )
    met = keyed.join(bounded(verdict.withColumnsRenamed({"rank": "__rank", "text_key": "__key"})), ["__rank", "__key"], "left")
    split = met.withColumn("__lines", F.split("__text", "\n", -1)).withColumn("__sorted", _sorted_lines(F.coalesce("__text", F.lit(""))))
    kept = split.withColumn("__first", F.expr("transform(filter(__sorted, (p, j) -> j = 0 or p.line <> __sorted[j - 1].line), p -> p.at)"))
    kept = kept.withColumn("__stay", F.array_except("__first", F.coalesce("__gone", F.array().cast("array<int>"))))
    blank = F.filter(F.transform("__lines", lambda x, i: F.when(~x.rlike(f"[^{SPACE}]"), i)), lambda i: i.isNotNull())
    kept = kept.withColumn("__at", F.sort_array(F.concat("__stay", blank)))
    result = F.when(F.size("__at") == F.size("__lines"), F.col("__text")).otherwise(F.expr("array_join(transform(__at, i -> __lines[i]), '\\n')"))
    total = F.size("__sorted").cast("long")
    return kept.select(
        *(result.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c in others or c == text_col),
        total.alias("n_lines"), (total - F.size("__stay")).alias("n_removed"), F.coalesce("__near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce(F.expr("aggregate(__links, 0L, (x, p) -> x + p.links)"), F.lit(0)).cast("long").alias("n_links"),
    )
