"""Fuzzy line deduplication by MinHash, in DataFrame operations alone.

Lines are classes by their hash. A class's character shingles are hashed, and a
signature takes, for each of PERMUTATIONS constants, the least and the greatest
hash after exclusive-or with it: both are min-hashes, of one order and of its
reverse. Each of the first BANDS pairs is a band; classes that agree in a band
are candidates if their lengths and enough of their signatures agree. Candidates
are compared with the most frequent class of their bucket; once those links are
merged, those left over with the most frequent class among them, and so on while
that merges enough. Then every pair of a bucket's classes that are still in
different components is compared, crowded buckets by pairs of blocks; the rounds
before only spare pairs whose ends are in one component by then. Of these pairs
odd sketches of the shingle sets rule out those that aren't similar enough.
Exact Jaccard similarity of the two shingle sets decides. Links go to the
distributed union-find; of each component the first line stays.
"""

from __future__ import annotations

from collections.abc import Callable
from random import Random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstack.llm.common import materialize, partitions
from quillstack.llm.components import components

#: Characters (UTF-16 units) of a shingle, the similarity in percent, permutations and bands.
SHINGLE, PERCENT, PERMUTATIONS, BANDS = 8, 80, 7, 5
#: Values, of two a permutation, that must agree for a candidate. At similarity 0.8, with values taken as independent, 0.2 % of
#: pairs have fewer, and 0.6 % have no band in common.
AGREE = 7
#: Rounds of comparing with leaders, at most; they end when a bucket's row has no more than PAIRS_LEFT pairs on average, or a
#: round finds less than one in WORTH of the links.
ROUNDS, PAIRS_LEFT, WORTH = 6, 64, 50
#: Classes of a block of a crowded bucket.
BLOCK = 256
#: Keys (8 bytes each) that may be broadcast; with more, the same join is shuffled.
BROADCAST_KEYS = 1_000_000
#: Characters of a blank line.
BLANKS = " \t\n\x0b\f\r"
#: Shingles of a line hashed in one row.
STEP = 8
#: Longs of an odd sketch, and the standard errors beyond which it rules a pair out.
ODD, ERRORS = 16, 3.0
#: Pairs verified in a task, and tasks at most.
PAIRS, MOST_PARTS = 4000, 20_000
#: Columns of a class of lines that comparisons need.
CLASS = ("key", "shingles", "v0", "v1", "component")
_random = Random(20)
MASKS = [_random.getrandbits(64) - 2**63 for _ in range(PERMUTATIONS)]
#: Seven lanes of a long, a byte each: the value 127 and the top bit.
SEVENS, TOPS = sum(127 << 8 * i for i in range(7)), sum(128 << 8 * i for i in range(7))


def line_rows(docs: DataFrame) -> DataFrame:
    """A row per \\n-separated line: doc_id, text_key, line_no, line; key is null for blank lines."""
    text = F.col("text").cast("string")
    # hashed below the generator: beside it, a text would be hashed again for each of its lines
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    d = d.select("doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # a pattern would be matched in a copy of each line in UTF-16
    return d.withColumn("key", F.when(F.ltrim("line", F.lit(BLANKS)) != "", F.xxhash64("line")))


def shingle_at(units: Column, i: Column, size: int = SHINGLE) -> Column:
    """Hash of the i-th shingle (from 0) of a line in UTF-16."""
    return F.xxhash64(F.substr(units, 2 * i + 1, F.lit(2 * size)))


def last_shingle(units: Column, size: int = SHINGLE) -> Column:
    """Number of the last shingle; a shorter line is one shingle."""
    return F.greatest((F.octet_length(units) / 2).cast("int") - size, F.lit(0))


def shingle_hashes(line: Column, part: Callable[[Column], Column] = lambda h: h) -> Column:
    """Array of the shingle hashes of a line, or of a part of them, repeats included.

    The line is encoded once, as the element of an outer array. Inside, which
    Spark interprets, only a start that is given is hashed.
    """
    starts = lambda units: F.sequence(F.lit(1), 2 * last_shingle(units) + 1, F.lit(2))
    each = lambda units: F.transform(starts(units), lambda at: part(F.xxhash64(F.substr(units, at, F.lit(2 * SHINGLE)))))
    return F.transform(F.array(F.encode(line, "UTF-16BE")), each)[0]


def shingle_set(line: Column, part: Callable[[Column], Column] = lambda h: h) -> Column:
    """Array of the different shingle hashes of a line, or of a part of them; they are taken in compiled code."""
    return F.array_distinct(shingle_hashes(line, part))


def signatures(lines: DataFrame) -> DataFrame:
    """(key, shingles, copies, s0 .. s13): number of shingles, number of lines and signature of each class of lines."""
    units = lines.where("key is not null").select("key", F.encode("line", "UTF-16BE").alias("units")).withColumn("last", last_shingle(F.col("units")))
    # a row has STEP shingles, the last one again where there are fewer: minima and maxima stay the same
    each = units.select("key", "last", "units", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(STEP))).alias("i"))
    each = each.select("key", "last", "i", *[shingle_at(F.col("units"), F.least(F.col("i") + j, F.col("last"))).alias(f"h{j}") for j in range(STEP)])
    # the greatest by the least with the other bits flipped: no two aggregates share an expression, which Spark would hold in fields of an object
    least = lambda m: F.min(F.least(*[F.col(f"h{j}").bitwiseXOR(F.lit(m)) for j in range(STEP)]))
    lanes = [lane.alias(f"s{2 * i + j}") for i, m in enumerate(MASKS) for j, lane in enumerate((least(m), F.bitwise_not(least(~m))))]
    return each.groupBy("key").agg((F.max("last") + 1).alias("shingles"), F.count_if(F.col("i") == 0).alias("copies"), *lanes)


def packed_lanes(first: int) -> Column:
    """Seven signature values in one long, seven bits each."""
    out = F.lit(0).cast("long")
    for i in range(7):
        out = out.bitwiseOR(F.shiftleft(F.col(f"s{first + i}").bitwiseAND(F.lit(127)), 8 * i))
    return out


def met_in_buckets(signed: DataFrame) -> DataFrame:
    """A row per class and band that it shares: bucket and m, the number of classes there, in place of bands.

    Rows are dealt by bucket once, for their counts and for themselves.
    """
    posted = signed.withColumn("bucket", F.explode("bands")).drop("bands")
    return posted.withColumn("m", F.count("*").over(Window.partitionBy("bucket"))).where("m > 1")


def alike(x: str, y: str, percent: int, agree: int) -> Column:
    """Whether the lengths allow the similarity and enough of the 14 signature values agree; x and y name prefixes of columns."""
    col = lambda side, c: F.col(f"{side}{c}")
    apart = lambda c: F.bit_count((col(x, c).bitwiseXOR(col(y, c)) + F.lit(SEVENS)).bitwiseAND(F.lit(TOPS)))
    sizes = col(x, "shingles"), col(y, "shingles")
    return (200 * F.least(*sizes) >= percent * F.greatest(*sizes)) & (14 - apart("v0") - apart("v1") >= agree)


def without_unlike_twos(met: DataFrame, percent: int, agree: int) -> DataFrame:
    """met without the buckets of two classes that aren't alike.

    Rows lie by bucket already, so the other class of two is read off a window,
    as the exclusive-or of both and its own, with neither a shuffle nor a join.
    """
    other = lambda c: F.bit_xor(c).over(Window.partitionBy("bucket")).bitwiseXOR(F.col(c))
    seen = met.withColumns({f"y_{c}": other(c) for c in ("shingles", "v0", "v1")})
    return seen.where((F.col("m") > 2) | alike("", "y_", percent, agree)).select(*met.columns)


def leader() -> Column:
    """Of a bucket's classes that aren't led, the one of the greatest rank, as a struct (null if there is none), over a window by bucket."""
    return F.max(F.when(~F.col("led"), F.struct("rank", *CLASS))).over(Window.partitionBy("bucket"))


def with_leaders(named: DataFrame) -> DataFrame:
    """Pairs x, y of a class that isn't led and the leader of its bucket, in different components; rows are dealt by bucket once."""
    x, y = [F.col(c).alias(f"x_{c}") for c in CLASS], [F.col(f"lead.{c}").alias(f"y_{c}") for c in CLASS]
    return named.withColumn("lead", leader()).where("not led and component <> lead.component").select(*x, *y)


def still_open(named: DataFrame, merged: DataFrame, first: bool) -> DataFrame:
    """named with the components of merged (key, component): classes of their leader's are led, and buckets of one component go.

    The first leaders go, too, as they have met every class of their buckets.
    Rows are dealt by key once and by bucket once, for all that is asked of a bucket.
    """
    now = named.withColumnRenamed("component", "own").join(merged, "key", "left").withColumn("component", F.coalesce("component", "own"))
    now = now.select(*named.columns).withColumn("lead", leader())
    if first:
        now = now.where("key <> lead.key")
    end = lambda f: f("component").over(Window.partitionBy("bucket"))
    now = now.withColumns({"low": end(F.min), "high": end(F.max)}).where("low <> high")
    return now.withColumn("led", F.col("led") | F.coalesce(F.col("component") == F.col("lead.component"), F.lit(False))).select(*named.columns)


def joined_by(merged: DataFrame, links: DataFrame) -> DataFrame:
    """The components (key, component) that links (a, b) make of those of merged; only these, not their members, are linked anew."""
    for end in ("a", "b"):
        links = links.join(prefixed(merged, "of_").withColumnRenamed("of_key", end), end, "left").withColumn(end, F.coalesce("of_component", end)).drop("of_component")
    new = components(links).select(F.col("node").alias("component"), F.col("component").alias("low"))
    known = merged.join(new, "component", "full")
    return known.select(F.coalesce("key", "component").alias("key"), F.coalesce("low", "component").alias("component"))


def with_candidates(met: DataFrame, close: Column) -> DataFrame:
    """The classes of met that are close to another one of their bucket, m counted anew.

    Classes of buckets of two are, as without_unlike_twos leaves no others; they take no part in the join.
    """
    more = in_blocks(met.where("m > 2"), close, "left_semi").select("bucket", *[F.col(f"x_{c}").alias(c) for c in met.columns if c not in ("bucket", "m")]).distinct()
    more = more.withColumn("m", F.count("*").over(Window.partitionBy("bucket")))
    return met.where("m = 2").unionByName(more)


def ordered(df: DataFrame) -> DataFrame:
    """Pairs of x_key and y_key as distinct (a, b), a below b."""
    return df.select(F.least("x_key", "y_key").alias("a"), F.greatest("x_key", "y_key").alias("b")).distinct()


def prefixed(df: DataFrame, prefix: str, *keep: str) -> DataFrame:
    """df with a prefix to the names of its columns but those to keep."""
    return df.select(*keep, *[F.col(c).alias(prefix + c) for c in df.columns if c not in keep])


def pairs_left(named: DataFrame) -> int:
    """Pairs of classes of one bucket and different components."""
    sizes = named.groupBy("bucket", "component").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"))
    return int(sizes.agg(F.sum(F.col("n") * F.col("n") - F.col("same"))).first()[0] or 0) // 2


def in_blocks(named: DataFrame, near: Column, how: str = "inner", block: int = BLOCK) -> DataFrame:
    """The pairs x, y of classes of one bucket and different components that are `near`, once a bucket; or (semi) their x.

    A bucket of more classes than a block is dealt to blocks by the hash of the
    class, and its pairs to as many tasks as there are pairs of blocks. Pairs
    that aren't near leave no row.
    """
    dealt = named.withColumn("of", F.ceil(F.col("m") / block).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("key"), F.col("of")).cast("int")).drop("m")
    x = dealt.withColumn("other", F.explode(F.sequence(F.lit(0) if how == "left_semi" else F.col("block"), F.col("of") - 1)))
    y = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1 if how == "left_semi" else F.col("block"))))
    x = prefixed(x.withColumnsRenamed({"block": "i", "other": "j"}).drop("of"), "x_", "bucket", "i", "j")
    y = prefixed(y.withColumnsRenamed({"other": "i", "block": "j"}).drop("of"), "y_", "bucket", "i", "j").withColumnsRenamed({c: f"y_{c}" for c in ("bucket", "i", "j")})
    same = (F.col("bucket") == F.col("y_bucket")) & (F.col("i") == F.col("y_i")) & (F.col("j") == F.col("y_j")) & (F.col("x_component") != F.col("y_component"))
    once = F.lit(True) if how == "left_semi" else (F.col("i") < F.col("j")) | (F.col("x_key") < F.col("y_key"))
    return x.join(y, same & once & near, how)


def sketches(texts: DataFrame) -> DataFrame:
    """(key, size, odd): number of different shingles, and an odd sketch: bits that as many shingles as make an odd number fall on.

    The sketch's longs are one array, which a join's condition reads only where its other parts hold.
    """
    # dealt by key once: the grouping then stays in its task
    bits = texts.repartition("key").select("key", F.explode(shingle_set(F.col("line"), lambda h: F.shiftright(h, 32).cast("int"))).alias("h"))
    bits = bits.withColumn("at", F.pmod("h", F.lit(64 * ODD)))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("at", F.lit(64)).cast("int"))
    lanes = [F.bit_xor(F.when(F.shiftright("at", 6) == i, bit).otherwise(F.lit(0).cast("long"))) for i in range(ODD)]
    return bits.groupBy("key").agg(F.count("*").cast("int").alias("size"), F.array(*lanes).alias("odd"))


def hopeful(x: str, y: str, percent: int) -> Column:
    """False where odd sketches differ in more bits, by ERRORS standard errors and one, than sets so similar can."""
    odd = sum((F.bit_count(F.get(f"{x}odd", F.lit(i)).bitwiseXOR(F.get(f"{y}odd", F.lit(i)))) for i in range(ODD)), F.lit(0))
    bits = 64 * ODD
    most = (F.col(f"{x}size") + F.col(f"{y}size")) * (100 - percent) / (100 + percent)  # elements that only one has
    far = F.exp(-4 * most / bits)
    mean = bits / 2 * (1 - F.sqrt(far))
    return odd <= mean + 1 + ERRORS * F.sqrt(F.greatest(bits / 4 * (1 - far) - most * far, F.lit(0.0)))


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose shingle sets are similar enough, by exact Jaccard similarity.

    A row holds the hashes of its pair, and nothing else is kept in memory. A
    set is no larger than its line has shingles, so where these numbers suffice
    for the similarity, the different hashes of both aren't taken.
    """
    both = pairs.join(texts.select(F.col("key").alias("a"), F.col("line").alias("la")), "a").join(texts.select(F.col("key").alias("b"), F.col("line").alias("lb")), "b")
    parts = max(partitions(pairs.sparkSession), min(-(-pairs.count() // PAIRS), MOST_PARTS))
    hashes = both.repartition(parts, "a", "b").select("a", "b", shingle_hashes(F.col("la")).alias("ha"), shingle_hashes(F.col("lb")).alias("hb"))
    hashes = hashes.withColumn("common", F.size(F.array_intersect("ha", "hb")).cast("long"))
    enough = lambda union: 100 * F.col("common") >= percent * union
    similar = F.when(enough(F.size("ha") + F.size("hb") - F.col("common")), True).otherwise(enough(F.size(F.array_union("ha", "hb")).cast("long")))
    # unfolded, as a plain filter would be computed before the rows are dealt to tasks
    return hashes.select("a", "b", F.explode(F.array(similar)).alias("similar")).where("similar").select("a", "b")


def texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, line): one line of each class among keys, whose number is checked before they are broadcast."""
    wanted = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    return materialize(line_rows(docs).where("key is not null").select("key", "line").join(wanted, "key", "left_semi").distinct(), "lines")


def lines(docs: DataFrame, *, percent: int = PERCENT, agree: int = AGREE) -> DataFrame:
    """A row per line that isn't blank: doc_id, text_key, line_no, first_doc_id, first_line_no and kept.

    Lines of similarity percent/100 or more are in one component, as are their
    links; `first_*` is its first line by doc_id (nulls first) and line number,
    the one that is kept. Null and empty texts have no such lines. Repeated rows
    are told apart, and keep one line. Other columns are left out.
    """
    spark = docs.sparkSession
    here = materialize(line_rows(docs).drop("line").withColumn("row", F.monotonically_increasing_id()), "occurrences")
    filled = here.where("key is not null")
    signed = signatures(line_rows(docs))
    bands = F.array(*[F.xxhash64(F.lit(i), F.col(f"s{2 * i}"), F.col(f"s{2 * i + 1}")) for i in range(BANDS)])
    # the rank of a class: how often it occurs, then its key
    rank = F.shiftleft(F.least("copies", F.lit(2**30)), 32).bitwiseOR(F.col("key").bitwiseAND(F.lit(2**32 - 1)))
    signed = signed.select("key", "shingles", rank.alias("rank"), packed_lanes(0).alias("v0"), packed_lanes(7).alias("v1"), bands.alias("bands"))
    met = without_unlike_twos(met_in_buckets(signed), percent, agree).withColumn("component", F.col("key"))
    # classes with no candidate in a bucket leave it
    close = alike("x_", "y_", percent, agree)
    met = materialize(with_candidates(materialize(met, "buckets"), close), "met")
    texts = texts_of(docs, materialize(met.select("key").distinct(), "keys"))
    named = met.withColumn("led", F.lit(False))
    most = PAIRS_LEFT * met.count()
    pairs = links = spark.createDataFrame([], "a long, b long")
    for turn in range(ROUNDS):
        # those in no component of an earlier leader with the most frequent of them
        near = with_leaders(named).where(close)
        new = materialize(ordered(near).join(pairs, ["a", "b"], "left_anti"), "pairs")
        found = materialize(verified(new, texts, percent), "links")
        pairs, links = pairs.unionByName(new), links.unionByName(found)
        merged = components(links).withColumnRenamed("node", "key")
        named = materialize(still_open(named, merged, not turn), "named")
        if pairs_left(named) <= most or found.count() * WORTH <= links.count():
            break
    # the rest: every pair of a bucket that is still apart and that neither signatures nor sketches rule out
    rest = named.select("bucket", "m", *CLASS)
    met_by = materialize(in_blocks(rest, close, "left_semi").select("bucket", F.col("x_key").alias("key")).distinct(), "close")
    drawn = materialize(sketches(texts.join(met_by.select("key").distinct(), "key", "left_semi")), "sketches")
    rest = rest.join(met_by, ["bucket", "key"], "left_semi").join(drawn, "key")
    more = ordered(in_blocks(rest, close & hopeful("x_", "y_", percent))).join(pairs, ["a", "b"], "left_anti")
    more = materialize(more, "pairs")
    merged = joined_by(merged, materialize(verified(more, texts, percent), "links"))
    # the first line of each class, then of each component of several classes
    first = filled.groupBy("key").agg(F.min(F.struct("doc_id", "line_no", "row")).alias("first"))
    firsts = merged.join(first, "key").groupBy("component").agg(F.min("first").alias("foremost"))
    named = filled.join(first, "key").join(merged.join(firsts, "component").select("key", "foremost"), "key", "left")
    named = named.withColumn("first", F.coalesce("foremost", "first"))
    return named.select(
        "doc_id", "text_key", F.col("line_no").cast("long").alias("line_no"), F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.line_no").cast("long").alias("first_line_no"), (F.col("row") == F.col("first.row")).alias("kept"),
    )


def dedup(docs: DataFrame, **options: int) -> DataFrame:
    """docs with the lines that aren't kept cut from their texts, and n_chars, if there is one, counted anew.

    A document that had lines and loses all of them is dropped, so a repeated
    row is; blank lines, and documents with nothing else, stay as they are.
    Other columns keep their values, whatever their names. No rows give no rows.
    """
    table = lines(docs, **options)
    numbers = lambda which: F.collect_list(F.when(which, F.col("line_no").cast("int")))
    # of a repeated row, a line is lost if no copy keeps it
    same = lambda i: {"doc": F.coalesce(i, F.lit(0)), "no_doc": i.isNull()}
    lost = table.withColumns(same(F.col("doc_id"))).groupBy("doc", "no_doc", F.col("text_key").alias("key")).agg(
        F.count_if("kept").alias("left"), F.count_if(~F.col("kept")).alias("n"), F.array_except(numbers(~F.col("kept")), numbers(F.col("kept"))).alias("lost")
    ).where("n > 0").drop("n")
    # texts are shuffled once, with equal keys for the join and the window
    text = F.col("text").cast("string")
    others = F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("row")
    keyed = docs.select(others, text.alias("text"), F.xxhash64(text).alias("key"), *[c.alias(k) for k, c in same(F.col("doc_id").cast("long")).items()])
    joined = keyed.join(lost, ["doc", "no_doc", "key"], "left")
    # a row of a repeated pair (doc_id, text) that isn't the first has no lines left
    turn = F.row_number().over(Window.partitionBy("doc", "no_doc", "key").orderBy(F.lit(0)))
    joined = joined.withColumn("turn", turn).where(F.col("lost").isNull() | ((F.col("turn") == 1) & (F.col("left") > 0))).withColumn("lines", F.split("text", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost"))
    cut = F.when(F.col("lost").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    changed = {"text": cut, "n_chars": F.length(cut).cast("long")}
    return joined.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
