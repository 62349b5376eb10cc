"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is the set of its paragraphs: lines, cut further at sentence ends, and where that leaves
more than ``LONG`` characters, after the words (characters, in scripts without spaces and in
words longer than that) whose hash is 0 modulo ``EVERY``, so an edit moves the cuts beside it
only. Each digest is
added to three cells, one in each third of the sketch; a cell holds a count, the xor of its
digests and the xor of their check hashes. Two versions' sketches of one size subtract cell by
cell: what they share cancels. Peeling then recovers what differs: a cell whose count is 1 or
-1 and whose check fits holds one digest; it is taken out of its other two cells, which may
leave those with one digest, and so on. A sketch that doesn't peel empty is made again, four
times as large and with other hashes.

The fingerprint string is the smallest sketch (``BASE`` cells a third): count, digest and check of
every cell in hex. Two texts that differ in a few paragraphs are compared by these very sketches;
sketches that are sure to be too small are skipped: the first size tried holds the difference that
the ``NEAREST`` smallest digests of both sets let expect. Likeness is shared over all digests (1
for two empty texts).

Everything is DataFrame expressions. The cells of a pair are rows keyed by the pair, so a
round of peeling is a flat map and one aggregation. A round takes its cells from one third: a
digest is in one cell of it, so none is taken out twice. The pairs' rows stay in the partitions
of the join that brought their texts together, and no round shuffles. Empty cells are no rows.
Retries are rare, and read the documents concerned only. A document's other results ride along as
a note on one row, so the plan below is evaluated once.

Digests are made where the texts are read; they and the texts are shuffled once, by document, to
partitions of bounded size; all later steps read that exchange or the small ones of what documents
hand to their predecessors.

Defined cases: a null text is empty; rows with equal id and text are one document, given back as
often as it stands; rows with equal ids are in the order of their texts' hashes; a null id orders
last; a single document is its own next; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm import common as C

#: Cells of a third of the sketch in the fingerprint string, the least there is.
BASE = 8
LEAST = BASE
#: Cells a differing digest (as expected) in the first sketches of a pair, and how many smallest
#: digests of either set tell what to expect.
CELLS_EACH = 6.0
NEAREST = 32
#: Rounds of peeling before a sketch counts as failed; its successor is GROW times as large.
ROUNDS = 7
GROW = 4
#: Documents to be tried again whose keys are broadcast; with more, a shuffle brings them together.
FEW = 200_000
#: Text bytes of a partition: bounds the sketches that a task holds.
PART_BYTES = 4_000_000
#: Sentence ends: those before white space only, and in scripts that put none.
PLAIN_ENDS = r"([.!?])[ \t]+"
ENDS = r"([.!?\u0964\u061f\u06d4\u1362])[ \t]+|([\u3002\uff01\uff1f\uff0e\uff61])[ \t]*"
OTHER_ENDS = "\u0964\u061f\u06d4\u1362\u3002\uff01\uff1f\uff0e\uff61"
#: Longer paragraphs are cut after one in EVERY of their words.
LONG = 200
EVERY = 16
#: Places after a word of a long paragraph: white space, and any character of a script without spaces.
PLAIN_WORD_ENDS = r"(?<=\s)(?=\S)"
WORD_ENDS = r"(?<=\s)(?=\S)|(?<=[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u3400-\u9fff\uf900-\ufaff\x{20000}-\x{3ffff}])"
_LAST = 2**63 - 1
KEY = ["ord", "h"]
#: Rows that are no cells: recovered digests of either side, and a note.
_GONE, _COME, _NOTE = -1, -2, -3


def _is_long(part: Column) -> Column:
    return F.length(part) > LONG


def _cut_after(units: Column) -> Column:
    """The pieces of a text given by its units: a piece ends with a unit whose hash says so.
    Parts have no line break, so one marks the cuts."""
    is_end = lambda u: F.pmod(F.xxhash64(F.rtrim(u)), F.lit(EVERY)) == 0
    marked = F.array_join(F.transform(units, lambda u: F.when(is_end(u), F.concat(u, F.lit("\n"))).otherwise(u)), "")
    return F.filter(F.split(marked, "\n"), lambda p: p != "")


def _let(value: Column, body) -> Column:
    """body(value), the value being evaluated once."""
    return F.transform(F.array(value), body)[0]


def _pieces(part: Column) -> Column:
    """A part, if long cut into pieces; in words that are long themselves, characters decide."""
    characters = lambda w: F.when(_is_long(w), F.split(w, "(?<=.)(?=.)")).otherwise(F.array(w))
    is_ascii = F.length(part) == F.octet_length(part)
    words = F.when(is_ascii, F.split(part, PLAIN_WORD_ENDS)).otherwise(F.split(part, WORD_ENDS))
    units = lambda w: F.when(F.exists(w, _is_long), F.flatten(F.transform(w, characters))).otherwise(w)
    return F.when(_is_long(part), _cut_after(_let(words, units))).otherwise(F.array(part))


def digests(text: Column) -> Column:
    """The set of the paragraph digests of a text, rising."""
    has_others = F.lit(False)
    for end in OTHER_ENDS:
        has_others = has_others | F.contains(text, F.lit(end))
    lines = F.when(has_others, F.regexp_replace(text, ENDS, "$1$2\n")).otherwise(F.regexp_replace(text, PLAIN_ENDS, "$1\n"))
    parts = F.filter(F.split(lines, "\n"), lambda p: p != "")
    cut = lambda ps: F.when(F.exists(ps, _is_long), F.flatten(F.transform(ps, _pieces))).otherwise(ps)
    return F.sort_array(F.array_distinct(F.transform(_let(parts, cut), lambda p: F.xxhash64(p))))


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def slot(digest: Column, third, width: Column, seed: int) -> Column:
    """The cell of a digest in a third of a sketch."""
    return F.lit(third) * width + F.pmod(F.xxhash64(digest, F.lit(third), F.lit(seed)), width)


def fingerprint(found: Column, base: int = BASE) -> Column:
    """The sketch of fixed size as text."""
    width = F.lit(base).cast("long")
    xor = lambda of, f: F.aggregate(of, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x[f]))

    def told(held):
        return F.concat(F.lpad(F.hex(F.size(held)), 8, "0"), F.lpad(F.hex(xor(held, "d")), 16, "0"), F.lpad(F.hex(xor(held, "chk")), 16, "0"))

    def third(placed, i):
        cells = F.sequence(F.lit(i * base).cast("long"), F.lit((i + 1) * base - 1).cast("long"))
        return F.transform(cells, lambda k: _let(F.filter(placed, lambda x: x[f"s{i}"] == k), told))

    slots = lambda d: [slot(d, i, width, 0).alias(f"s{i}") for i in range(3)]
    placed = F.transform(found, lambda d: F.struct(d.alias("d"), check(d).alias("chk"), *slots(d)))
    return F.lower(_let(placed, lambda p: F.array_join(F.concat(*[third(p, i) for i in range(3)]), "")))


def documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """text (null: empty), and its place in the order: ord (the id) and h (hash of the text; of
    the greatest id and of null ids, which have its ord, with the sign telling which it is)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    h = F.xxhash64("text")
    bits = F.shiftrightunsigned(h, 1)
    h = F.when(F.col("doc_id").isNull(), bits).when(F.col("doc_id") == _LAST, bits.bitwiseOR(F.lit(-(2**63)))).otherwise(h)
    return rows.select(F.coalesce("doc_id", F.lit(_LAST)).alias("ord"), h.alias("h"), "text")


def _doc_id() -> Column:
    return F.when((F.col("ord") != _LAST) | (F.col("h") < 0), F.col("ord"))


def neighbours(source: DataFrame) -> DataFrame:
    """ord, h, n (code points), times (rows), and the document before in the order: p_ord, p_h,
    p_n (of the first: the last). Ids and lengths only; no task sees more than its range of ids."""
    spark = source.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = source.groupBy(*KEY, F.length("text").cast("long").alias("n")).agg(F.count(F.lit(1)).alias("times"))
    ranged = C.cut(ids.repartitionByRange(parts, *KEY).withColumn("part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("part").orderBy(*KEY)
    row = F.struct(*KEY, "n")
    lasts = ranged.groupBy("part").agg(F.max(row).alias("last"))
    around = Window.orderBy("part")  # one row per range partition
    lasts = lasts.withColumn("carried", F.lag("last").over(around)).withColumn(
        "carried", F.coalesce("carried", F.last("last").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    led = ranged.withColumn("before", F.lag(row).over(inside)).join(F.broadcast(lasts.select("part", "carried")), "part")
    before = F.coalesce("before", "carried")
    return led.select(*KEY, "n", "times", before["ord"].alias("p_ord"), before["h"].alias("p_h"), before["n"].alias("p_n"))


def versions(source: DataFrame, order: DataFrame, parts: int) -> DataFrame:
    """Each document with its edited text and the digests of its own and its successor's text:
    ord, h, n, times, edited, own, next."""
    told = order.withColumnsRenamed({"ord": "o_ord", "h": "o_h"})
    placed = source.withColumn("own", digests(F.col("text"))).repartition(parts, *KEY).dropDuplicates(KEY)
    full = placed.join(told.hint("merge"), (F.col("ord") == F.col("o_ord")) & (F.col("h") == F.col("o_h")))
    given = full.select(
        F.col("p_ord").alias("g_ord"),
        F.col("p_h").alias("g_h"),
        F.expr("substring(text, 1, cast(p_n div 4 AS INT))").alias("donor"),
        F.col("own").alias("next"),
    )
    both = full.join(given, (F.col("ord") == F.col("g_ord")) & (F.col("h") == F.col("g_h")))
    edited = F.concat(F.expr("substring(text, 1, cast(n - n div 4 AS INT))"), "donor")
    return both.select(*KEY, "n", "times", edited.alias("edited"), "own", "next")


def expected_difference(a: Column, b: Column) -> Column:
    """How many digests differ, by the share of common ones among the smallest of both (exact
    where these are all; else one less is taken as common, so that few sketches are too small)."""
    low = [F.slice(F.sort_array(x), 1, NEAREST) for x in (a, b)]
    either = F.slice(F.sort_array(F.array_union(*low)), 1, NEAREST)
    common = F.size(F.array_intersect(either, F.array_intersect(*low)))
    all_of_them = (F.size(a) <= NEAREST) & (F.size(b) <= NEAREST)
    common = F.when(all_of_them, common).otherwise(F.greatest(common - 1, F.lit(0)))
    share = common / F.greatest(F.size(either), F.lit(1))
    return (F.size(a) + F.size(b)) * (F.lit(1.0) - share) / (F.lit(1.0) + share)


def peel(
    pairs: DataFrame, key: list[str], grow: int = 1, seed: int = 0, rounds: int | None = None, keep_digests: bool = False
) -> DataFrame:
    """Difference of two digest sets by sketch: for rows of ``key`` with the arrays a and b
    and a text ``note`` (null: none): key, gone (digests only in a), come (only in b), left
    (cells not peeled: 0 on success) and the note. Equal sets without a note give no row.
    With ``keep_digests`` also the recovered digests themselves.

    ``key`` must be what the rows are partitioned by already, else Spark shuffles once."""
    need = expected_difference(F.col("a"), F.col("b"))
    width = F.greatest(F.ceil(need * F.lit(CELLS_EACH * grow / 3)), F.lit(LEAST * grow)).cast("long")
    zero = F.lit(0).cast("long")

    def entry(cell, c, digest, chk, tag=zero):
        return F.struct(
            cell.cast("long").alias("cell"), c.cast("long").alias("c"), digest.alias("key"), chk.alias("chk"), tag.alias("tag")
        )

    kept = [*key, "w", "note"]

    def merged(df):
        group = [*kept, "cell"] + (["tag"] if keep_digests else [])
        return df.groupBy(*group).agg(F.sum("c").alias("c"), F.bit_xor("key").alias("key"), F.bit_xor("chk").alias("chk")).where(
            "c <> 0 OR key <> 0 OR chk <> 0"
        )

    def signed(digest, s):
        return F.struct(digest.cast("long").alias("d"), F.lit(s).alias("s"))

    marker = F.when(F.col("note").isNotNull(), F.array(signed(zero, 0))).otherwise(F.array().cast("array<struct<d:bigint,s:int>>"))
    entries = F.concat(F.transform("a", lambda d: signed(d, 1)), F.transform("b", lambda d: signed(d, -1)), marker)
    cells = pairs.select(*key, width.alias("w"), "note", F.explode(entries).alias("x"))
    d, sign, w = F.col("d"), F.col("s"), F.col("w")
    cells = cells.select(*key, "w", F.when(F.col("x.s") == 0, F.col("note")).alias("note"), "x.*").withColumn("chk", check(d))
    three = F.array(*[entry(slot(d, i, w, seed), sign, d, F.col("chk")) for i in range(3)])
    one = F.array(entry(F.lit(_NOTE), F.lit(1), zero, zero))
    cells = merged(cells.select(*kept, F.explode(F.when(sign == 0, one).otherwise(three)).alias("x")).select(*kept, "x.*"))
    for r in range(ROUNDS if rounds is None else rounds):
        third = r % 3
        digest, c, chk = F.col("key"), F.col("c"), F.col("chk")
        pure = (F.col("cell") >= third * w) & (F.col("cell") < (third + 1) * w) & (F.abs(c) == 1) & (chk == check(digest))
        out = [entry(F.when(c > 0, _GONE).otherwise(_COME), F.lit(1), zero, zero, digest)]
        out += [entry(slot(digest, i, w, seed), -c, digest, chk) for i in range(3) if i != third]
        same = entry(F.col("cell"), c, digest, chk, F.col("tag") if keep_digests else zero)
        cells = merged(cells.select(*kept, F.explode(F.when(pure, F.array(*out)).otherwise(F.array(same))).alias("x")).select(*kept, "x.*"))

    def found(mark):
        return F.coalesce(F.sum(F.when(F.col("cell") == mark, F.col("c"))), zero)

    extra = []
    if keep_digests:
        extra = [F.collect_list(F.when(F.col("cell") == m, F.col("tag"))).alias(f"{n}_digests") for m, n in ((_GONE, "gone"), (_COME, "come"))]
    return cells.groupBy(*key).agg(
        found(_GONE).alias("gone"), found(_COME).alias("come"), F.count(F.when(F.col("cell") >= 0, 1)).alias("left"),
        F.max("note").alias("note"), *extra
    )


def likeness(a: Column, gone: Column, come: Column) -> Column:
    every = a + come
    return F.when(every == 0, 1.0).otherwise((a - gone) / every)


PAIRS = ("edited", "next")


def _pairs(found: DataFrame, note: bool) -> DataFrame:
    """One row per document and pair: key, pair, a, b, note (of the first pair: what the
    document itself shows, as text)."""
    sha = F.sha2(F.col("edited").cast("binary"), 256)
    rows = found.select(*KEY, "n", "times", sha.alias("sha"), F.col("own").alias("a"), digests(F.col("edited")).alias("other"), "next")
    shown = F.concat_ws(",", "n", "times", F.size("a"), "sha", fingerprint(F.col("a")), fingerprint(F.col("other")))
    both = F.array(
        F.struct(F.lit(0).alias("pair"), F.col("other").alias("b"), (shown if note else F.lit(None).cast("string")).alias("note")),
        F.struct(F.lit(1).alias("pair"), F.col("next").alias("b"), F.lit(None).cast("string").alias("note")),
    )
    return rows.select(*KEY, "a", F.explode(both).alias("x")).select(*KEY, "x.pair", "a", "x.b", "x.note")


def _wide(peeled: DataFrame) -> DataFrame:
    """Both pairs of a document in one row."""
    picks = [F.max(F.when(F.col("pair") == i, F.col(c))).alias(f"{c}_{n}") for i, n in enumerate(PAIRS) for c in ("gone", "come", "left")]
    return peeled.groupBy(*KEY).agg(*picks, F.max("note").alias("note"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", retries: int = 8) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    source = documents(docs, doc_id, text)
    order = C.cut(neighbours(source), "order")
    parts = max(C.block_count(source, "text", PART_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = [*KEY, "pair"]
    # Hex digits halve under zstd, and hardly shrink under the default.
    table = C.cut(_wide(peel(_pairs(versions(source, order, parts), True), key)), "sketches", compression="zstd")
    counts = [f"{c}_{n}" for n in PAIRS for c in ("gone", "come")]
    failed = " OR ".join(f"coalesce(left_{n}, 0) > 0" for n in PAIRS)  # equal sets have no row
    again = table.where(failed).select(*KEY)
    done = []
    on = (F.col("ord") == F.col("r_ord")) & (F.col("h") == F.col("r_h"))
    for k in range(1, retries + 1):
        again = C.cut(again, "failed")
        if again.isEmpty():
            break
        # Only the failed documents and their successors are read again.
        mark = again.withColumnsRenamed({"ord": "f_ord", "h": "f_h"})
        few = again.count() <= FEW
        near = F.broadcast if few else (lambda df: df)
        is_own = (F.col("ord") == F.col("f_ord")) & (F.col("h") == F.col("f_h"))
        is_next = (F.col("p_ord") == F.col("f_ord")) & (F.col("p_h") == F.col("f_h"))
        some = C.cut(order.join(near(mark), is_own, "left_semi").union(order.join(near(mark), is_next, "left_semi")).distinct(), "again")
        keys = some.select(F.col("ord").alias("s_ord"), F.col("h").alias("s_h"))
        is_some = (F.col("ord") == F.col("s_ord")) & (F.col("h") == F.col("s_h"))
        texts = source.join(near(keys), is_some, "left_semi")
        pairs = _pairs(versions(texts, some, parts if not few else 1 + parts // 16), False).join(near(mark), is_own, "left_semi")
        result = _wide(peel(pairs, key, grow=GROW**k, seed=k)).drop("note").withColumnsRenamed({"ord": "r_ord", "h": "r_h"})
        result = C.cut(result, "retried")
        done.append(result.where(f"NOT ({failed})"))
        again = result.where(failed).select(F.col("r_ord").alias("ord"), F.col("r_h").alias("h"))
    else:
        if not again.isEmpty():
            raise RuntimeError("sketches of some documents did not peel")
    for better in done:
        new = better.select("r_ord", "r_h", *[F.col(c).alias(f"new_{c}") for c in counts], F.lit(True).alias("better"))
        table = table.join(new, on, "left")
        table = table.withColumns({c: F.when(F.col("better"), F.col(f"new_{c}")).otherwise(F.col(c)) for c in counts}).drop(
            "r_ord", "r_h", "better", *[f"new_{c}" for c in counts]
        )
    noted = F.split("note", ",")
    table = table.select(
        _doc_id().alias("doc_id"),
        noted[0].cast("long").alias("n_chars"),
        noted[1].cast("long").alias("times"),
        noted[2].cast("long").alias("n_own"),
        noted[3].alias("edited_sha256"),
        noted[4].alias("fingerprint"),
        noted[5].alias("edited_fingerprint"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
    )
    # One row for each of the rows.
    table = table.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    near = {f"near_{n}": likeness(F.col("n_own"), F.col(f"gone_{n}"), F.col(f"come_{n}")) for n in PAIRS}
    return table.withColumns(near).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *near)
