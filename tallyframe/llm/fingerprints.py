"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is the set of the 64-bit digests of its paragraph cells: runs of at most ``words`` words of one line. A sketch has three tables
of ``width`` cells; every digest is entered in one cell of each table, which counts it and takes it into the XOR of its digests and of
their checks. Two versions' sketches of one shape are subtracted cell by cell, so that common digests vanish. Then cells that hold a
single digest give it away, it is taken out of its other cells, and so on (peeling): what comes out are the digests that differ. If
cells are left, the sketch was too small: the digests are then dealt out to groups of about ``per_group`` by hash and compared group by
group with wider and wider sketches, so that work and sketch grow in proportion to the text. A group that even the widest sketch can't
solve is compared by its digests themselves. All of it is built-in array functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.shared import picked

WIDTHS, ROUNDS = (9, 48), 24


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digests(text: Column, words: int = 24) -> Column:
    """The set of a text's cell digests."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(rf"(?:\S++[^\S\n]*+){{1,{words}}}+"), F.lit(0)), lambda cell: F.xxhash64(cell)))


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def entries(signed: Column, width: int) -> Column:
    """{n, key} with their check and their cell in each table."""
    return F.transform(signed, lambda x: F.struct(x["n"].alias("n"), x["key"].alias("key"), check(x["key"]).alias("mark"),
                                                  *[F.pmod(F.xxhash64(x["key"], F.lit(t)), F.lit(width)).cast("int").alias(f"p{t}") for t in range(3)]))


def signed(found: Column, n: int) -> Column:
    return F.transform(found, lambda x: F.struct(F.lit(n).alias("n"), x.alias("key")))


def entered(cells: Column, placed: Column, width: int) -> Column:
    """Cells, table after table, with entries added to them; an entry of the opposite sign takes its digest out."""
    def cell(c, i, t):
        def with_held(held):
            return F.when(F.size(held) == 0, c).otherwise(F.struct((c["n"] + F.aggregate(held, F.lit(0), lambda a, e: a + e["n"])).alias("n"), F.aggregate(held, c["key"], lambda a, e: a.bitwiseXOR(e["key"])).alias("key"),
                                                                   F.aggregate(held, c["mark"], lambda a, e: a.bitwiseXOR(e["mark"])).alias("mark")))

        return let(F.filter(placed, lambda e: e[f"p{t}"] == i), with_held)

    def table(t):
        return F.transform(F.slice(cells, t * width + 1, width), lambda c, i: cell(c, i, t))

    return F.concat(*[table(t) for t in range(3)])


def sketch(found: Column, width: int, minus: Column | None = None) -> Column:
    """Three tables of ``width`` cells {n, key, mark} of a set of digests; with ``minus`` the difference to that set's sketch, as a
    digest entered with the opposite sign is one subtracted."""
    zero = F.lit(0).cast("long")
    empty = F.array_repeat(F.struct(F.lit(0).alias("n"), zero.alias("key"), zero.alias("mark")), 3 * width)
    given = signed(found, 1) if minus is None else F.concat(signed(found, 1), signed(minus, -1))
    return let(entries(given, width), lambda placed: entered(empty, placed, width))


def subtracted(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: F.struct((p["n"] - q["n"]).alias("n"), p["key"].bitwiseXOR(q["key"]).alias("key"), p["mark"].bitwiseXOR(q["mark"]).alias("mark")))


def peeled(cells: Column, width: int) -> Column:
    """The digests that differ, as {n, key} with n 1 for those of the first sketch only and -1 for those of the second; null if cells are left."""
    def pure(those):
        single = F.filter(those, lambda c: (F.abs(c["n"]) == 1) & (c["mark"] == check(c["key"])))
        return F.array_distinct(F.transform(single, lambda c: F.struct(c["n"].alias("n"), c["key"].alias("key"))))

    def state(those, found):
        return F.struct(those.alias("cells"), found.alias("found"), pure(those).alias("pure"))

    def step(now, _):
        out = F.transform(now["pure"], lambda x: F.struct((-x["n"]).alias("n"), x["key"].alias("key")))
        left = let(entries(out, width), lambda placed: entered(now["cells"], placed, width))
        return F.when(F.size(now["pure"]) == 0, now).otherwise(let(left, lambda those: state(those, F.concat(now["found"], now["pure"]))))

    start = let(cells, lambda those: state(those, F.array().cast("array<struct<n:int,key:bigint>>")))
    return let(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step),
               lambda s: F.when(F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["mark"] == 0)), s["found"]))


def plainly(a: Column, b: Column) -> Column:
    return F.concat(signed(F.array_except(a, b), 1), signed(F.array_except(b, a), -1))


def in_groups(a: Column, b: Column, per_group: int) -> Column:
    """The digests that differ, found group by group, a group again with a wider sketch whenever peeling fails. Dealt out in two steps,
    so that a long text's digests are not read once for each of its groups."""
    def solved(x, y):
        return F.coalesce(*[peeled(sketch(x, width, y), width) for width in WIDTHS], plainly(x, y))

    def share(these, salt, i, parts):
        return F.filter(these, lambda x: F.pmod(F.xxhash64(x, F.lit(salt)), parts) == i)

    def split(x, y, salt, parts, then):
        return F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda i: let(F.struct(share(x, salt, i, parts).alias("a"), share(y, salt, i, parts).alias("b")), lambda p: then(p["a"], p["b"]))))

    groups = F.greatest(F.lit(1.0), F.ceil((F.size(a) + F.size(b)) / F.lit(float(per_group))))
    return let(F.ceil(F.sqrt(groups)).cast("long"), lambda parts: split(a, b, "outer", parts, lambda x, y: split(x, y, "inner", parts, solved)))


def differing(a: Column, b: Column, width: int = 4, per_group: int = 10) -> Column:
    """{n, key} of every digest that is in one of two sets only (n is 1: in the first, -1: in the second), from fingerprints if they suffice."""
    first = peeled(subtracted(sketch(a, width), sketch(b, width)), width)
    return F.coalesce(first, in_groups(a, b, per_group))


def likeness(a: Column, b: Column, found: Column) -> Column:
    """Common digests as a share of all, from the sizes of the sets and of their difference; 1 for two empty sets."""
    both, off = F.size(a) + F.size(b), F.size(found)
    return F.when(both == 0, 1.0).otherwise((both - off) / (both + off))


def as_text(cells: Column) -> Column:
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(":", F.hex(c["n"]), F.hex(c["key"]), F.hex(c["mark"]))), ".")


def with_next(docs: DataFrame, bands: int | None = None) -> DataFrame:
    """Every row of (doc_id, text) with ``next_text``: the text of the row after it, by doc_id (null first), then text; the last row gets the first's.

    Rows are dealt out by bands of doc_id, cut at quantiles of all identifiers; a band's first row goes to the band before it too, as a
    guest, so that texts are shuffled once and no task has more than a few bands.
    """
    bands = bands or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts, first, has_null = docs.agg(F.percentile_approx("doc_id", [i / bands for i in range(1, bands)] or [0.5], 20 * bands), F.min("doc_id"), F.bool_or(F.col("doc_id").isNull())).first()
    bounds = sorted(set(cuts or []) - {first})
    step = max(1, int(len(bounds) ** 0.5))

    def constant(values):
        return (F.split(F.lit(",".join(map(str, values))), ",") if values else F.array()).cast("array<bigint>")

    def home(band, guest):
        return F.struct(band, F.lit(guest)).cast("struct<band:int,guest:int>")

    fine, coarse, own = constant(bounds), constant(bounds[step - 1::step]), F.col("doc_id")
    whole = F.size(F.filter(coarse, lambda b: b <= own)) * step
    band = F.coalesce(whole + F.when(F.lit(bool(bounds)), F.size(F.filter(F.slice(fine, whole + 1, F.lit(step)), lambda b: b <= own))).otherwise(0), F.lit(0))
    is_first = own.isNull() if has_null else own == F.lit(first)
    homes = F.array_compact(F.array(home(F.col("band"), 0), F.when((F.col("band") > 0) & (F.try_element_at(fine, F.col("band")) == own), home(F.col("band") - 1, 1)), F.when(is_first, home(F.lit(len(bounds)), 2))))
    dealt = docs.withColumn("band", band.cast("int")).withColumn("home", F.explode(homes)).select("doc_id", "text", F.col("home.band").alias("band"), F.col("home.guest").alias("guest"))
    order = Window.partitionBy("band").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return dealt.withColumn("next_text", F.lead("text").over(order)).where("guest = 0").select("doc_id", "text", "next_text")


def edited(text: Column, next_text: Column) -> Column:
    """The last floor(n / 2) code points replaced by the first as many, or all, of the next text."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(next_text, F.lit(1), half))


def fingerprints(docs: DataFrame, width: int = 4, words: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint, its edited text's, and how like they are to each other and to the next document's.

    Result: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, changed (the digests {n, key} that
    the edit removed, n 1, or added, n -1). Null text counts as empty; a null doc_id comes first; rows with one doc_id follow each
    other by text; a single row is its own next; an empty table gives an empty result; other columns are ignored.
    """
    rows = picked(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    texts = with_next(rows).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    sets = texts.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                        *[digests(F.col(c), words).alias(name) for c, name in (("text", "own"), ("edited", "other"), ("next_text", "following"))])
    own, other, following = F.col("own"), F.col("other"), F.col("following")
    compared = sets.withColumn("changed", differing(own, other, width)).withColumn("from_next", differing(own, following, width))
    return compared.select("doc_id", "n_chars", "edited_sha256", as_text(sketch(own, width)).alias("fingerprint"), as_text(sketch(other, width)).alias("edited_fingerprint"),
                           likeness(own, other, F.col("changed")).alias("near_edited"), likeness(own, following, F.col("from_next")).alias("near_next"), "changed")
