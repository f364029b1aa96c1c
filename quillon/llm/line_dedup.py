"""Line dedup by an exact set-similarity join, in DataFrame functions only.

A line is the set of its words. Tokens are ordered by rarity (word counts over all lines, in
a table of fixed size by hash), and two lines of Jaccard 0.8 or more share a token of their
prefixes. Pairs that meet in a prefix token pass the length, positional and bitmap filters
before their sets are compared; prefixes are one token longer than one common token asks
for, so that a pair has to meet twice. A line goes if an earlier line (by document id, text hash
and line number) has the same set or one of Jaccard 0.8 or more, be that one kept or not.

Equal lines are one node from the start. Groups of variants are found first: among the lines
that share the least or the largest hash of the rarer half of their words, in a band of
sizes, each meets a few earlier ones. Then only lines that are not matched yet probe
all prefix buckets, in which matched lines stay visible: no match is lost, and a group of n
variants costs about n comparisons. Spark splits hot tokens of the probing join. A line's text
is found again by the hash of its place.

A null or empty text is one line without words; such lines are never removed. Very long
texts are ordinary rows: a line is one array of words, and nothing else grows with it. Rows
that repeat id and text lose the same lines. An empty table gives an empty table. Columns of
any name besides doc_id and text are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.common import bits_of, cut, drop_cuts, has_bit, swept, text_or_empty

#: Counters of the rarity table, one byte each; the driver holds this table and no more.
COUNTERS = 1 << 18
#: Counters that come to the driver as one row.
CHUNK = 1 << 12
#: Lines before a line that it is compared with when variants are looked for.
NEIGHBOURS = 8
#: Of these, the ones with the likest bitmaps whose sets are compared; one match is enough.
LIKEST = 2
#: Parts that the lines are dealt out to when variants are looked for.
PARTS = 1 << 16
#: Prefixes are so much longer that a pair shares this many of their tokens (or its only word).
SHARED = 2
#: A token's row has open (1 bit), size and the token's place (26 bits each, for 67 million
#: distinct words in a line) in one long, in this order.
FIELD = 26
MASK = (1 << FIELD) - 1


def _pieces(text: str, ends: str = " ") -> Column:
    """Words of a text, cut at single spaces; rarer white space becomes one first. There may
    be empty pieces. ends: white space of its own kind that the text may hold."""
    odd = F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\x0b")) | F.contains(text, F.lit("\f")) | F.contains(text, F.lit("\r"))
    plain = F.col(text) if ends == " " else F.replace(text, F.lit(ends), F.lit(" "))
    return F.split(F.when(odd, F.translate(text, "\t\n\x0b\f\r", "     ")).otherwise(plain), " ")


def _hashes(line: str) -> Column:
    """Hashes of the distinct words; that of the empty pieces goes."""
    return F.array_remove(F.array_distinct(F.transform(_pieces(line), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def _slot(h: Column) -> Column:
    return h.bitwiseAND(F.lit(COUNTERS - 1)).cast("int")


def rarity(docs: DataFrame) -> Column:
    """COUNTERS bytes, each a rank that is higher for commoner words, from the counts of all
    words of all lines."""
    words = docs.select(text_or_empty().alias("text")).select(F.explode(_pieces("text", "\n")).alias("w")).where("w != ''")
    counts = words.groupBy(_slot(F.xxhash64("w")).alias("slot")).agg(F.count("*").alias("n"))
    rank = F.least(F.lit(126), 1 + F.floor(3 * F.log2("n"))).cast("int")
    rows = counts.groupBy(F.floor(F.col("slot") / CHUNK).alias("chunk")).agg(F.collect_list((F.col("slot") % CHUNK) * 128 + rank).alias("ranks"))
    table = bytearray(b"\x01" * COUNTERS)
    with swept(docs.sparkSession):
        found = rows.collect()
    for chunk, ranks in found:
        for x in ranks:
            table[chunk * CHUNK + (x >> 7)] = x & 127
    return F.lit(bytes(table))


def _rank(ranks: Column, h: Column) -> Column:
    return F.ascii(F.substring(ranks, _slot(h) + 1, 1).cast("string")).cast("long")


def _split(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), line_no from 0, line; one row for each line."""
    hashed = docs.select("doc_id", F.xxhash64("text").alias("th"), text_or_empty().alias("text"))
    return hashed.select("doc_id", "th", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _lines(docs: DataFrame) -> DataFrame:
    """The lines with a word."""
    return _split(docs).where(F.col("line").rlike("[^ \\t-\\r]"))


def _number(place: str = "") -> Column:
    return F.xxhash64(f"{place}doc_id", f"{place}th", f"{place}line_no")


def _place() -> Column:
    """Earlier lines compare lower; documents without an id come last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "line_no")


def _nodes(docs: DataFrame) -> DataFrame:
    """Distinct lines: lid, number (hash of the place), l1, l2 (hashes), first (place), copies, n, parity, upper, prefix, common
    (ranks of the rarest words), ends (least and largest hash among the rarer half of the words)."""
    ranks = rarity(docs)
    c = F.col
    lines = _lines(docs).select(_place().alias("first"), F.xxhash64("line").alias("l1"), F.hash("line").alias("l2"), _hashes("line").alias("h"))
    # rank of the word's counter above 56 bits of its hash
    key = lambda h: F.shiftleft(_rank(ranks, h), 56).bitwiseOR(h.bitwiseAND(F.lit((1 << 56) - 1)))
    sets = lines.select("first", "l1", "l2", F.sort_array(F.transform("h", key)).alias("t"), F.size("h").alias("n"))
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("bigint"), t.bitwiseAND(F.lit(63)).cast("int"))
    parity = F.aggregate("t", F.lit(0).cast("bigint"), lambda a, t: a.bitwiseXOR(bit(t)))
    # of the tokens whose next bit is set: with parity these are the parities of 128 slots
    upper = F.aggregate(F.filter("t", lambda t: t.bitwiseAND(F.lit(64)) != 0), F.lit(0).cast("bigint"), lambda a, t: a.bitwiseXOR(bit(t)))
    first = F.slice("t", 1, (c("n") - F.floor((4 * c("n") + 4) / 5) + SHARED).cast("int"))
    common = sum((F.coalesce(F.shiftright(F.get("t", F.lit(k)), 56), F.lit(0)) for k in range(3)), F.lit(0))
    prefix = F.transform(first, lambda t: t.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    # the rarer half of the words, so that no bucket is one of common words
    half = F.transform(F.slice("t", 1, F.ceil(c("n") / 2).cast("int")), lambda t: t.bitwiseAND(F.lit((1 << 56) - 1)))
    rows = sets.select("l1", "l2", "first", "n", parity.alias("parity"), upper.alias("upper"), prefix.alias("prefix"), common.cast("int").alias("common"), half.alias("half"))
    ends = F.array_distinct(F.transform(F.array(F.array_min("half"), F.array_max("half")), lambda h: h.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")))
    rows = rows.withColumn("ends", ends).drop("half")
    merged = rows.groupBy("l1", "l2").agg(F.min("first").alias("first"), F.count("*").alias("copies"), *(F.first(x).alias(x) for x in ("n", "parity", "upper", "prefix", "common", "ends")))
    return cut(merged.select("*", F.monotonically_increasing_id().alias("lid"), _number("first.").alias("number")), "lines")


def _size(meta: Column) -> Column:
    return F.shiftright(meta, FIELD).bitwiseAND(F.lit(MASK))


def _alike(differ: Column, n: Column) -> Column:
    """Whether sets with n words in all may have Jaccard 0.8, so 4/9 of n in common, if so many bits differ."""
    return 9 * differ <= n


def _fit(m1: Column, b1: Column, m2: Column, b2: Column) -> Column:
    """Bitmap, length and positional (for the first SHARED common tokens) filters."""
    n1, n2, p1, p2 = _size(m1), _size(m2), m1.bitwiseAND(F.lit(MASK)), m2.bitwiseAND(F.lit(MASK))
    places = 9 * (F.least(n1 - p1, n2 - p2) + (SHARED - 1)) >= 4 * (n1 + n2)
    return _alike(F.bit_count(b1.bitwiseXOR(b2)), n1 + n2) & (5 * F.least(n1, n2) >= 4 * F.greatest(n1, n2)) & places


def _wide(m1: Column, b1: Column, u1: Column, m2: Column, b2: Column, u2: Column) -> Column:
    """The bitmap filter by 128 slots: those of upper, and those of the others."""
    upper = u1.bitwiseXOR(u2)
    return _alike(F.bit_count(upper) + F.bit_count(b1.bitwiseXOR(b2).bitwiseXOR(upper)), _size(m1) + _size(m2))


def _tokens(nodes: DataFrame, open_: Column, prefix: Column) -> DataFrame:
    """token, lid, meta, parity, upper: a row for each token of the prefix."""
    meta = F.shiftleft(open_.cast("long"), 2 * FIELD).bitwiseOR(F.shiftleft(F.col("n").cast("long"), FIELD))
    rows = nodes.select("lid", "parity", "upper", meta.alias("head"), F.posexplode(prefix).alias("pos", "token"))
    return rows.select("token", "lid", F.col("head").bitwiseOR(F.col("pos").cast("long")).alias("meta"), "parity", "upper")


def _variants(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of a line with earlier ones of its band of sizes that share an end: of the
    NEIGHBOURS just before it and the one with the commonest words, for what a group of
    variants has in common is most of such a line, the LIKEST. They only spare the probing: a
    line that is not matched here probes all, so none is lost."""
    c = F.col
    band = F.floor(F.log("n") / F.log(F.lit(1.25))).cast("long")
    tokens = nodes.select("lid", c("n"), "parity", "common", "first", band.alias("band"), F.explode("ends").alias("token"))
    tokens = tokens.select("lid", "n", "parity", "common", "first", F.shiftleft(c("token").cast("long"), 8).bitwiseOR(c("band")).alias("of"))
    # many groups in a partition of the window, one after the other: most have a line or two
    before = Window.partitionBy(F.shiftright("of", 8).bitwiseAND(F.lit(PARTS - 1))).orderBy("of", "first", "lid")
    fields = ("of", "lid", "n", "parity")
    best = F.max(F.struct("of", "common", "lid", "n", "parity")).over(before.rowsBetween(Window.unboundedPreceding, -1))
    met = tokens.select(*fields, best.alias("best"), *(F.lag(x, k).over(before).alias(f"{x}{k}") for k in range(1, NEIGHBOURS + 1) for x in fields)).where("of1 = of")
    met = met.select("*", *(c(f"best.{x}").alias(f"{x}0") for x in fields))
    # the line with the commonest words may be one of the neighbours, too
    met = met.withColumn("of0", F.when(~F.coalesce(c("lid0").isin(*(c(f"lid{k}") for k in range(1, NEIGHBOURS + 1))), F.lit(False)), c("of0")))
    known = range(NEIGHBOURS + 1)
    # lines of a band are of fitting length; differing bits above the other's place, so that the likest come first
    differ = lambda k: F.bit_count(c("parity").bitwiseXOR(c(f"parity{k}")))
    fit = lambda k: F.when((c(f"of{k}") == c("of")) & (c(f"lid{k}") != c("lid")) & _alike(differ(k), c("n") + c(f"n{k}")), 16 * differ(k) + k)
    fits = [c(f"fit{k}") for k in known]
    met = met.select("lid", *(c(f"lid{k}") for k in known), *(fit(k).alias(f"fit{k}") for k in known))
    ranked = met.withColumn("rank0", F.least(*fits)).where("rank0 is not null")
    for k in range(1, LIKEST):
        ranked = ranked.withColumn(f"rank{k}", F.least(*(F.when(f > c(f"rank{k - 1}"), f) for f in fits)))
    other = lambda r: F.get(F.array(*(c(f"lid{k}") for k in known)), F.col(r).bitwiseAND(F.lit(15)))
    pairs = ranked.select("lid", F.explode(F.array(*(other(f"rank{k}") for k in range(LIKEST)))).alias("other")).where("other is not null")
    return pairs.select(F.greatest("lid", "other").alias("a"), F.least("lid", "other").alias("b")).distinct()


def _probed(nodes: DataFrame, matched: DataFrame) -> DataFrame:
    """Pairs (a, b) that share SHARED prefix tokens and pass the filters, one of them not matched."""
    flags = nodes.join(matched.withColumnRenamed("lid", "done"), F.col("lid") == F.col("done"), "left")
    tokens = _tokens(flags, F.col("done").isNull(), F.col("prefix"))
    x, y = (lambda f: F.col(f"x.{f}")), (lambda f: F.col(f"y.{f}"))
    is_open = lambda s: s("meta") >= F.lit(1 << 2 * FIELD)
    # one expression over both sides, so that these stay one exchange
    meets = F.when(is_open(x) & is_open(y), x("lid") < y("lid")).otherwise(is_open(x) & (x("lid") != y("lid")))
    both = tokens.alias("x").join(tokens.alias("y"), (x("token") == y("token")) & meets & _fit(x("meta"), x("parity"), y("meta"), y("parity")) & _wide(x("meta"), x("parity"), x("upper"), y("meta"), y("parity"), y("upper")))
    # two lines of one word each have no more to share
    shared = F.sum(F.when(_size(x("meta")) < SHARED, SHARED).otherwise(1))
    return both.groupBy(F.greatest("x.lid", "y.lid").alias("a"), F.least("x.lid", "y.lid").alias("b")).agg(shared.alias("k")).where(F.col("k") >= SHARED).select("a", "b")


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """lid, l1, l2 of each pair's later line, where the sets' Jaccard is 0.8 or more. The sets are
    read again from the texts; a fixed table of bits keeps most other lines from the join. Where rows
    repeat, a line's set is there as often, and one of them is kept."""
    c = F.col
    lids = pairs.select(c("a").alias("wanted")).unionByName(pairs.select(c("b").alias("wanted"))).distinct()
    wanted = cut(nodes.join(lids, c("lid") == c("wanted"), "left_semi").select("lid", c("number").alias("wanted")), "wanted")
    seen = bits_of(wanted, c("wanted"))
    lines = _split(docs).withColumn("number", _number()).where(has_bit(seen, c("number")))
    found = lines.join(wanted, c("number") == c("wanted")).select("lid", _place().alias("first"), "line").dropDuplicates(["lid"])
    sets = found.select("lid", "first", F.xxhash64("line").alias("l1"), F.hash("line").alias("l2"), _hashes("line").alias("h"))
    one = sets.select(c("lid").alias("a"), F.struct("first", "lid", "l1", "l2").alias("x"), c("h").alias("ha"))
    two = sets.select(c("lid").alias("b"), F.struct("first", "lid", "l1", "l2").alias("y"), c("h").alias("hb"))
    both = pairs.join(one, "a").join(two, "b")
    both = both.where(9 * F.size(F.array_intersect("ha", "hb")) >= 4 * (F.size("ha") + F.size("hb")))
    later = both.select(F.greatest("x", "y").alias("z")).select("z.lid", "z.l1", "z.l2")
    out = cut(later.distinct(), "matched")
    drop_cuts(wanted)
    return out


def find(docs: DataFrame) -> DataFrame:
    """l1, l2, first of the distinct lines that are repeated or have an earlier match, and
    `matched`: the latter. Of lines that are not repeated first is null."""
    docs = docs.select("doc_id", "text")
    nodes = _nodes(docs)
    near = cut(_variants(nodes), "near")
    matched = _verified(docs, nodes, near)
    pairs = cut(_probed(nodes, matched.select("lid")), "pairs")
    more = _verified(docs, nodes, pairs)
    drop_cuts(near, pairs)
    copied = nodes.where("copies > 1").select("l1", "l2", "first", F.lit(False).alias("matched"))
    hits = matched.unionByName(more).select("l1", "l2", F.lit(None).cast(nodes.schema["first"].dataType).alias("first"), F.lit(True).alias("matched"))
    found = copied.unionByName(hits).groupBy("l1", "l2").agg(F.min("first").alias("first"), F.max("matched").alias("matched"))
    found = cut(found, "found")
    drop_cuts(nodes, matched, more)
    return found


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, th and removed, the sorted numbers of the lines to remove; only documents that
    lose a line. th is the hash of the text, so rows that repeat an id keep apart unless
    they repeat the text too; such rows are the same lines and lose the same ones."""
    found = find(docs).withColumnsRenamed({"l1": "f1", "l2": "f2"})
    lines = _split(docs.select("doc_id", "text")).withColumn("l1", F.xxhash64("line")).where(has_bit(bits_of(found, F.col("f1")), F.col("l1")))
    lines = lines.select(_place().alias("place"), "l1", F.hash("line").alias("l2"))
    gone = lines.join(found, (F.col("l1") == F.col("f1")) & (F.col("l2") == F.col("f2"))).where(F.col("matched") | (F.col("place") > F.col("first")))
    return gone.select("place.doc_id", "place.th", "place.line_no").groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))


def _changed(docs: DataFrame) -> DataFrame:
    """row (all of the document) and removed, null where the text stays as it is."""
    gone = removed_lines(docs).select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "removed")
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(gone, (F.xxhash64("row.text") == F.col("t")) & F.col("row.doc_id").eqNullSafe(F.col("d")), "left").select("row", "removed")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and removed_lines (numbers from 0) of every document."""
    gone = removed_lines(docs).withColumnsRenamed({"doc_id": "d", "th": "t"})
    text = text_or_empty()
    n_lines = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    short = docs.select("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("th"), n_lines.alias("n_lines"))
    both = short.join(gone, (F.col("th") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
    lost = F.coalesce("removed", F.array().cast("array<int>"))
    return both.select("doc_id", "n_lines", F.size(lost).cast("long").alias("n_removed"), lost.alias("removed_lines"))


def clean(docs: DataFrame) -> DataFrame:
    """docs with the removed lines cut out of text, and n_chars, if there, counted anew. Texts
    that lose no line stay as they are; a text that loses all becomes empty."""
    parts = F.transform(F.split("row.text", "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    kept = F.array_join(F.transform(F.filter(parts, lambda s: ~F.array_contains("removed", s["i"])), lambda s: s["x"]), "\n")
    both = _changed(docs).select("row", F.when(F.col("removed").isNotNull(), kept).alias("kept"))
    row = F.col("row").withField("text", F.coalesce("kept", "row.text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("kept").isNull(), F.col("row.n_chars")).otherwise(F.char_length("kept").cast(docs.schema["n_chars"].dataType)))
    return both.select(row.alias("row")).select("row.*")
