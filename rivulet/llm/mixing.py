"""Mixing sources to target weights, by blocks of words and a drawn order of sources.

Each source's documents, in the order of a hash, are one stream of words, packed into
blocks of ``BLOCK`` words.  The mix is a row of slots of one block each, cut into
shards.  Every slot draws its source, so a shard's counts of sources are a multinomial
draw with the targets as weights; draws beyond a source's target go to sources that
fell short, so that the totals are exact.  A source's k-th slot takes the block that a
pseudorandom permutation of its block numbers gives for k, one permutation a pass, and
slots and blocks are joined by (source, block).

Only DataFrame functions are used.  Texts are read once, for their sizes; what is
shuffled are rows of numbers.  Equal rows are one row with a count until the end, and
running totals go by pieces, so neither a hot source nor a repeated row makes a large
task.  All draws are md5 values of numbers: reruns agree, on any partitions.

Defined results.  A null text has no words.  Documents without words are taken 0
times.  Null sources come last and are one source.  Rows of one doc_id with different
texts are different documents; rows that are the same share what their text is taken,
the earlier ones one word more where it doesn't divide.  No rows give no rows.  Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm.common import shared_table, table
from rivulet.operators.windows import row_number_skew_safe

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating; the mix's share of all words; most passes over a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
#: Words a block, slots a shard, rounds of a permutation.
BLOCK = 512
SHARD = 4096
ROUNDS = 24
#: Rows that one window piece of a running total holds.
STRIDE = 8192


def number(*parts) -> Column:
    """A pseudorandom 60-bit number of its parts."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def before(df: DataFrame, value: str, at: str, out: str, key: str | None = None) -> DataFrame:
    """``df`` with ``out``, the sum of ``value`` over the rows of its key with a smaller ``at`` (an integer, unique in a key).

    Sums of pieces of STRIDE places first, then inside the pieces.
    """
    keys = [key] if key else []
    rows = df.withColumn("__piece", F.expr(f"{at} div {STRIDE}"))
    over = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, "__piece").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    pieces = (rows.groupBy(*keys, "__piece").agg(F.sum(value).alias("__sum"))
              .withColumn("__past", F.coalesce(F.sum("__sum").over(over), F.lit(0))).drop("__sum"))
    return (rows.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0))).join(pieces, [*keys, "__piece"])
            .withColumn(out, F.col(out) + F.col("__past")).drop("__piece", "__past"))


# ---------------------------------------------------------------- sizes and targets

def printed(docs: DataFrame) -> DataFrame:
    """(source, doc_id, text, print): print names a (doc_id, text)."""
    id_, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.concat(F.coalesce(id_.cast("string"), F.lit("-")), F.lit(":"), text)
    return docs.select(F.col("source").cast("string").alias("source"), id_.alias("doc_id"), text.alias("text"),
                       F.md5(name.cast("binary")).alias("print"))


def sized(docs: DataFrame) -> DataFrame:
    """(source, doc_id, print, size, copies), a row for each different document of a source."""
    rows = printed(docs).select("source", "doc_id", "print", F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"))
    return rows.groupBy("source", "doc_id", "print", "size").agg(F.count(F.lit(1)).alias("copies"))


def targets(spark: SparkSession, sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = PASSES) -> DataFrame:
    """(source, no, words, target) of each source; ``no`` counts them by code point from 0, null last.

    A source gets its weight's part of the whole, at most ``most`` times its words; what
    is over goes to the others by weight, round after round.  A round is one sum over
    the sources, of which the driver sees the totals only.
    """
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    keyed = shared_table(spark, sources.withColumn("last", F.col("source").isNull()).withColumn("all", F.lit(0)), "mix-sources", free=False)
    numbered = row_number_skew_safe(keyed, "all", ["last", "source"], "no").select("source", "words", (F.col("no") - 1).alias("no"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    numbered = shared_table(spark, numbered.withColumn("weight", weight).withColumn("cap", F.col("words") * most), "mix-sources", free=False)
    total = (numbered.agg(F.sum("words")).first()[0] or 0) * share
    level, held = 0.0, -1
    while True:
        full = F.col("cap") < level * F.col("weight")
        row = numbered.agg(F.count(F.when(full, 1)), F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        if row[0] == held or not row[2]:
            break
        held, level = row[0], (total - (row[1] or 0)) / row[2]
    return numbered.select("source", "no", "words", F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"))


# ---------------------------------------------------------------- slots

def permuted(x: Column, n: Column, keys: Column, *name) -> Column:
    """Place of ``x`` in a pseudorandom permutation of 0..n-1: in each round x may change places with key - x mod n.

    ``keys``: (k, i) of each round, k below n.  The pair decides by a hash of its larger
    member, so both agree: any n is permuted, without a table.
    """
    def change(at: Column, key: Column) -> Column:
        other = F.pmod(key["k"] - at, n)
        text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in (*name, key["i"], F.greatest(at, other))])
        return F.when(F.substring(F.md5(text.cast("binary")), 1, 1) < "8", other).otherwise(at)
    return F.aggregate(keys, x, change)


def round_keys(n: Column, *name) -> Column:
    """(k, i) of each round: one key below n."""
    return F.transform(F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
                       lambda i: F.struct((number("key", *name, i) % n).alias("k"), i.alias("i")))


def planned(sources: DataFrame, block: int) -> DataFrame:
    """Sources with ``goal`` (whole words of the target), ``blocks`` a pass, ``full`` ones and ``slots`` of the mix."""
    goal = F.floor("target").cast("long")
    blocks = F.expr(f"(words + {block - 1}) div {block}")
    slots = F.expr(f"case when words = 0 then 0 else (goal div words) * blocks + (goal % words + {block - 1}) div {block} end")
    return (sources.withColumn("goal", goal).withColumn("blocks", blocks).withColumn("full", F.expr(f"words div {block}"))
            .withColumn("slots", slots))


def shard_counts(spark: SparkSession, plan: DataFrame, slots: int, shard: int) -> DataFrame:
    """(shard, no, count, first): how many slots of a shard a source has, and the number of its first one.

    Slots draw their source; the draws over a source's ``slots`` are given, in order, to
    the sources that were drawn too rarely.
    """
    # Cells of equal width over the drawn numbers; a source lies in a run of cells, so a slot meets those of its cell only.
    width = max(1, slots // max(1, plan.count()))
    spans = before(plan.filter("slots > 0"), "slots", "no", "low").select("no", "slots", "low", (F.col("low") + F.col("slots")).alias("high"))
    cells = spans.select("no", "low", "high", F.explode(F.expr(f"sequence(low div {width}, (high - 1) div {width})")).alias("cell"))
    drawn = (spark.range(slots).select(F.expr(f"id div {shard}").alias("shard"), (number("draw", F.col("id")) % slots).alias("u"))
             .withColumn("cell", F.expr(f"u div {width}")).join(cells, "cell").filter("u >= low and u < high")
             .groupBy("shard", "no").agg(F.count(F.lit(1)).alias("drawn")))
    drawn = shared_table(spark, drawn, "mix-drawn", free=False)
    kept = before(drawn, "drawn", "shard", "past", "no").join(plan.select("no", "slots"), "no")
    kept = shared_table(spark, kept.select("shard", "no", "drawn", F.expr("least(past + drawn, slots) - least(past, slots)").alias("kept")), "mix-kept", free=False)
    over = before(kept.groupBy("shard").agg(F.sum(F.col("drawn") - F.col("kept")).alias("over")).filter("over > 0"), "over", "shard", "begin")
    short = (plan.filter("slots > 0").select("no", "slots").join(kept.groupBy("no").agg(F.sum("kept").alias("kept")), "no", "left")
             .select("no", (F.col("slots") - F.coalesce("kept", F.lit(0))).alias("short")).filter("short > 0"))
    short = before(short, "short", "no", "begin")
    given = (over.select("shard", F.explode(F.expr("sequence(begin, begin + over - 1)")).alias("unit"))
             .join(short.select("no", F.explode(F.expr("sequence(begin, begin + short - 1)")).alias("unit")), "unit")
             .groupBy("shard", "no").agg(F.count(F.lit(1)).alias("kept")))
    counts = (kept.select("shard", "no", "kept").unionByName(given).groupBy("shard", "no").agg(F.sum("kept").alias("count"))
              .filter("count > 0"))
    return before(shared_table(spark, counts, "mix-counts", free=False), "count", "shard", "first", "no")


def slot_blocks(counts: DataFrame, plan: DataFrame, slots: int, block: int, shard: int) -> DataFrame:
    """(shard, slot, no, pass, block, take): the block of each slot and how many of its words the mix takes."""
    place = Window.partitionBy("shard").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    rows = (counts.withColumn("begin", F.coalesce(F.sum("count").over(place), F.lit(0)))
            .select("shard", "no", "first", "begin", F.posexplode(F.expr("sequence(first, first + count - 1)")).alias("i", "k"))
            .join(plan.select("no", "words", "goal", "blocks", "full"), "no")
            .withColumn("pass", F.expr("k div blocks")).withColumn("j", F.expr("k % blocks")))
    # A source's permutations, one a pass; the block that isn't full is each pass's last.
    keys = (plan.filter("full > 0").select("no", "full", F.explode(F.sequence(F.lit(0), F.lit(PASSES))).alias("pass"))
            .select("no", F.col("pass").cast("long").alias("pass"), round_keys(F.col("full"), "block", F.col("no"), F.col("pass")).alias("keys")))
    rows = rows.join(keys, ["no", "pass"], "left")
    at = F.when(F.col("j") < F.col("full"), permuted(F.col("j"), F.col("full"), F.col("keys"), "block", F.col("no"), F.col("pass"))) \
        .otherwise(F.col("full"))
    size = F.least(F.lit(shard).cast("long"), F.lit(slots) - F.col("shard") * shard)
    slot = permuted(F.col("begin") + F.col("i"), size, round_keys(size, "slot", F.col("shard")), "slot", F.col("shard"))
    take = F.least(F.lit(block).cast("long"), F.col("words") - F.col("j") * block, F.col("goal") - F.col("pass") * F.col("words") - F.col("j") * block)
    return rows.select("shard", slot.alias("slot"), "no", "pass", at.alias("block"), take.alias("take"))


# ---------------------------------------------------------------- blocks

def streams(spark: SparkSession, sizes: DataFrame, sources: DataFrame, documents: int) -> DataFrame:
    """Documents with words: (no, print, size, begin, end), where their copies stand in their source's stream of words."""
    pieces = max(1, -(-documents // STRIDE))
    rows = (sizes.filter("size > 0").join(sources.select(F.col("source").alias("of"), "no"), F.col("source").eqNullSafe(F.col("of")))
            .select("no", "print", "size", (F.col("size") * F.col("copies")).alias("length"),
                    F.expr(f"cast(conv(substring(print, 1, 8), 16, 10) as long) * {pieces} div {1 << 32}").alias("bucket")))
    sums = before(rows.groupBy("no", "bucket").agg(F.sum("length").alias("length")), "length", "bucket", "past", "no").select("no", "bucket", "past")
    inside = Window.partitionBy("no", "bucket").orderBy("print").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("part", F.sum("length").over(inside)).join(sums, ["no", "bucket"])
            .select("no", "print", "size", (F.col("past") + F.coalesce("part", F.lit(0))).alias("begin"), "length")
            .select("no", "print", "size", "begin", (F.col("begin") + F.col("length")).alias("end")))


def block_parts(streams: DataFrame, block: int) -> DataFrame:
    """(no, block, print, size, at, first, words): what a document has in a block, from word ``first`` of its copies on.

    Blocks go in groups of STRIDE, so that no row holds a list as long as a document's copies.
    """
    groups = F.explode(F.expr(f"sequence(begin div {block * STRIDE}, (end - 1) div {block * STRIDE})")).alias("group")
    low, high = f"greatest(begin div {block}, group * {STRIDE})", f"least((end - 1) div {block}, group * {STRIDE} + {STRIDE - 1})"
    return (streams.select("no", "print", "size", "begin", "end", groups)
            .select("no", "print", "size", "begin", "end", F.explode(F.expr(f"sequence({low}, {high})")).alias("block"))
            .select("no", "block", "print", "size", F.expr(f"greatest(begin - block * {block}, 0)").alias("at"),
                    F.expr(f"greatest(block * {block} - begin, 0)").alias("first"),
                    F.expr(f"least(end, (block + 1) * {block}) - greatest(begin, block * {block})").alias("words")))


class Mix:
    """The mix of a documents table.

    ``sizes`` and ``sources`` are its documents and sources; ``parts`` (shard, slot, no,
    pass, block, print, size, at, first, words) what each slot takes of a document.
    """

    def __init__(self, spark: SparkSession, docs: DataFrame, weights=WEIGHTS, share: float = SHARE, block: int = BLOCK, shard: int = SHARD):
        self.spark, self.given = spark, docs
        self.sizes = shared_table(spark, sized(docs), "mix-sizes")
        self.sources = shared_table(spark, targets(spark, self.sizes, weights, share), "mix-targets", free=False)
        plan = shared_table(spark, planned(self.sources, block), "mix-plan", free=False)
        slots = plan.agg(F.sum("slots")).first()[0] or 0
        counts = shard_counts(spark, plan, slots, shard)
        self.slots = slot_blocks(counts, plan, slots, block, shard)
        blocks = block_parts(streams(spark, self.sizes, self.sources, self.sizes.count()), block)
        words = F.least(F.col("words"), F.col("take") - F.col("at"))
        self.parts = self.slots.join(blocks, ["no", "block"]).filter("take > at").withColumn("words", words).drop("take")

    def taken(self) -> DataFrame:
        """A row per document: its size, its source's size and target, and the words that the mix takes of it."""
        taken = self.parts.groupBy("no", "print").agg(F.sum("words").alias("taken"))
        numbered = self.sizes.join(self.sources.withColumnRenamed("source", "of").withColumnRenamed("words", "source_size"),
                                   F.col("source").eqNullSafe(F.col("of")))
        groups = F.explode(F.expr(f"sequence(0L, (copies - 1) div {STRIDE})")).alias("group")
        copy = F.explode(F.expr(f"sequence(group * {STRIDE}, least(copies - 1, group * {STRIDE} + {STRIDE - 1}))")).alias("copy")
        share = F.expr("taken div copies + case when copy < taken % copies then 1 else 0 end")
        return (numbered.join(taken, ["no", "print"], "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
                .select("*", groups).select("*", copy)
                .select("doc_id", "source", "size", "source_size", "target", share.cast("long").alias("taken")))

    def texts(self) -> DataFrame:
        """(shard, slot, source, pass, text): the words of each slot, one space between them."""
        words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
        texts = printed(self.given).dropDuplicates(["source", "print"]).withColumnRenamed("source", "of").withColumnRenamed("print", "named")
        parts = self.parts.join(self.sources.select("no", "source"), "no")
        # A part may run over several copies of a document: one row for each.
        copies = F.explode(F.expr("sequence(first div size, (first + words - 1) div size)")).alias("copy")
        parts = (parts.select("*", copies).withColumn("low", F.expr("greatest(first - copy * size, 0)"))
                 .withColumn("high", F.expr("least(first + words - copy * size, size)")))
        rows = parts.join(texts, F.col("source").eqNullSafe(F.col("of")) & (F.col("print") == F.col("named")))
        piece = F.array_join(F.slice(words, (F.col("low") + 1).cast("int"), (F.col("high") - F.col("low")).cast("int")), " ")
        return (rows.select("shard", "slot", "source", "pass", F.struct("at", "copy", piece.alias("text")).alias("piece"))
                .groupBy("shard", "slot", "source", "pass")
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["text"]), " ").alias("text")))


def op11_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all ``documents`` takes of each."""
    return Mix(spark, table(spark, sf_dir, "documents", "doc_id", "source", "text")).taken()


# ---------------------------------------------------------------- the same in SQL

def _sql(block: int = BLOCK, shard: int = SHARD) -> str:
    def h(text: str) -> str:
        return f"cast('0x' || substr(md5({text}), 1, 15) as bigint)"
    weight = "case no % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end"
    bit = "substr(md5('block:' || p.no || ':' || p.pass || ':' || r || ':' || greatest(x, (((p.keys[r + 1] - x) % p.full_) + p.full_) % p.full_)), 1, 1) < '8'"
    return f"""
with docs as (
  select row_number() over () as row_id, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as size,
    md5(coalesce(doc_id::varchar, '-') || ':' || coalesce(text, '')) as print from documents),
src as (
  select source, words, no, {weight} as weight, 2 * words as cap
  from (select source, sum(size)::bigint as words, row_number() over (order by source is null, source) - 1 as no from docs group by source)),
filled as (
  select max((1.5::double * (select sum(words) from src)::double - caps) / left_) as level from (
    select coalesce(sum(cap) over w, 0)::double as caps, (select sum(weight) from src) - coalesce(sum(weight) over w, 0) as left_
    from src window w as (order by cap / weight, no rows between unbounded preceding and 1 preceding))),
plan as (
  select *, case when words = 0 then 0 else (goal // words) * blocks + (goal % words + {block - 1}) // {block} end as slots
  from (select *, floor(target)::bigint as goal, (words + {block - 1}) // {block} as blocks, words // {block} as full_
        from (select source, no, words, least(cap::double, level * weight) as target from src, filled))),
total as (select sum(slots)::bigint as n from plan),
spans as (select no, slots, (sum(slots) over (order by no))::bigint as high from plan where slots > 0),
draws as (select id // {shard} as shard, {h("'draw:' || id")} % n as u from total, unnest(range(n)) as t(id)),
drawn as (select d.shard, s.no, s.slots, count(*) as drawn from draws d join spans s on d.u >= s.high - s.slots and d.u < s.high group by all),
kept as (
  select shard, no, drawn, least(past + drawn, slots) - least(past, slots) as kept
  from (select *, (sum(drawn) over (partition by no order by shard))::bigint - drawn as past from drawn)),
over_ as (select shard, unnest(range(o)) + (sum(o) over (order by shard))::bigint - o as unit from (select shard, sum(drawn - kept)::bigint as o from kept group by shard)),
short as (select no, unnest(range(s)) + (sum(s) over (order by no))::bigint - s as unit
  from (select p.no, p.slots - coalesce(k.kept, 0) as s from plan p left join (select no, sum(kept)::bigint as kept from kept group by no) k on p.no = k.no)),
counts as (
  select shard, no, sum(kept)::bigint as c from (
    select shard, no, kept from kept union all select shard, no, 1 from over_ join short using (unit)) group by shard, no),
firsts as (select shard, no, c, (sum(c) over (partition by no order by shard))::bigint - c as first from counts),
places as (
  select no, words, goal, full_, k // blocks as pass, k % blocks as j
  from (select f.no, p.words, p.goal, p.blocks, p.full_, unnest(range(first, first + c)) as k from firsts f join plan p on f.no = p.no)),
keys as (
  select no, pass, list({h("'key:block:' || no || ':' || pass || ':' || r")} % full_ order by r) as keys
  from (select no, full_, pass, unnest(range({ROUNDS})) as r from (select no, full_, unnest(range({PASSES + 1})) as pass from plan where full_ > 0)) group by no, pass),
slots as (
  select no, least({block}, words - j * {block}, goal - pass * words - j * {block}) as take,
    case when j < full_ then list_reduce(list_prepend(j, range({ROUNDS})),
      lambda x, r: case when {bit} then (((p.keys[r + 1] - x) % p.full_) + p.full_) % p.full_ else x end) else full_ end as block
  from (select l.*, k.keys from places l left join keys k on l.no = k.no and l.pass = k.pass) p),
streams as (
  select no, print, (sum(length) over (partition by no order by print))::bigint - length as begin_, length
  from (select s.no, d.print, sum(d.size)::bigint as length from docs d join src s on d.source is not distinct from s.source
        where d.size > 0 group by s.no, d.print)),
parts as (
  select no, print, block, greatest(begin_ - block * {block}, 0) as at_, least(begin_ + length, (block + 1) * {block}) - greatest(begin_, block * {block}) as words
  from (select *, unnest(range(begin_ // {block}, (begin_ + length - 1) // {block} + 1)) as block from streams)),
taken as (
  select p.no, p.print, sum(least(p.words, s.take - p.at_))::bigint as taken
  from slots s join parts p on s.no = p.no and s.block = p.block where s.take > p.at_ group by p.no, p.print)
select doc_id, source, size, source_size, target, (taken // copies + case when copy < taken % copies then 1 else 0 end)::bigint as taken from (
  select d.doc_id, d.source, d.size::bigint as size, p.words as source_size, p.target, coalesce(t.taken, 0) as taken,
    count(*) over (partition by p.no, d.print) as copies, row_number() over (partition by p.no, d.print order by row_id) - 1 as copy
  from docs d join plan p on d.source is not distinct from p.source left join taken t on t.no = p.no and t.print = d.print)"""


ORACLE_SQL = _sql()
