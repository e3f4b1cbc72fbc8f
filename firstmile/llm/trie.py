"""Prefix trie of conversations by fixed-length block hashing.

1. Turns get a digest of role and text and their place in their conversation.
2. Conversations are cut into blocks of BLOCK turns. A block's key is the digest of
   all turns before it and of all turns up to its end, so conversations are grouped by
   one row a block, not one a turn, and copies are counted before they are shuffled.
3. Where all conversations that come to a border go on with the same block, the turns
   inside it have the same members and are read off the block. Only where siblings
   differ are turn borders refined: the turns of the distinct blocks, not of the
   conversations, are grouped by their own digests.

The digest of a prefix is the exclusive or of its turns' digests, each salted with its
depth: 128 bits that need no task to hold a conversation. Places and digests are
running totals over ranges of (conversation, order), with what earlier ranges hold
added, so a conversation that owns a third of all turns is many tasks' work.

Sums over subtrees need no walk: every node belongs to its smallest member, which owns
one unbroken run of nodes down to its own end. A node's subtree is what its members own
from it on, so each owner's total is added once to each block of its path.

The ids that end at a node are hashed in ascending order. They are first joined to
pieces of bounded length where they lie; one hash over the pieces follows.

Turns are ordered by `turn`, NULL first, equal ones by the digest of role and text.
NULL role or text is empty. Rows with a NULL conv_id take no part. A repeated row is a
turn of its own. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firstmile.llm import store

BLOCK = 4
#: Conversations of one family and the most turns that its first one lends.
FAMILY, HEADS = 20, 4
#: Characters of ids in one piece.
PIECE = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest of role and text, words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    known = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        # The length of the role says where it ends.
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("t"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("w"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("t")]
    return _running(known, "conv", order, {"place": ("sum", F.lit(1).cast("long"))}).select("conv", "place", "t", "w")


def _running(df: DataFrame, key: str, order: list[Column], totals: dict[str, tuple[str, Column]]) -> DataFrame:
    """Running totals (sum or bit_xor) of each key's rows in an order, the row itself included.

    Rows are dealt out by ranges of key and order and written, so that a key with very
    many rows lies in several ranges. At most one key a range goes on from ranges before
    it; what those hold is one row a range, joined by broadcast.
    """
    tag = F.monotonically_increasing_id()  # tells equal rows apart, so that ranges can part them
    dealt = df.select("*", *(value.alias(f"_{n}") for n, (_, value) in totals.items()), tag.alias("_tag"))
    dealt = store.land(dealt.repartitionByRange(key, *order, "_tag").withColumn("_range", F.spark_partition_id()), "ranges")
    # Equal rows share their totals but for their place among themselves: _tag settles it.
    inside = Window.partitionBy("_range", key).orderBy(*order, "_tag").rowsBetween(Window.unboundedPreceding, 0)
    fold = {"sum": F.sum, "bit_xor": F.bit_xor}
    join = {"sum": lambda a, b: a + b, "bit_xor": lambda a, b: a.bitwiseXOR(b)}
    pieces = dealt.groupBy(key, "_range").agg(*(fold[how](f"_{n}").alias(f"_{n}") for n, (how, _) in totals.items()))
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select(key, "_range", *(fold[how](f"_{n}").over(earlier).alias(f"_{n}_0") for n, (how, _) in totals.items()))
    before = store.land(before.where(F.col(f"_{next(iter(totals))}_0").isNotNull()), "before")
    within = dealt.select(*df.columns, "_range", *(fold[how](f"_{n}").over(inside).alias(f"_{n}") for n, (how, _) in totals.items()))
    joined = within.join(F.broadcast(before), [key, "_range"], "left")
    made = [join[how](F.col(f"_{n}"), F.coalesce(F.col(f"_{n}_0"), F.lit(0).cast("long"))).alias(n) for n, (how, _) in totals.items()]
    return joined.select(*df.columns, *made)


def lent(conv: Column) -> Column:
    """How many first turns a conversation takes from the first one of its family."""
    return F.crc32(conv.cast("string")) % HEADS


def rebuild(ordered: DataFrame) -> DataFrame:
    """conv, depth, t, w of every rebuilt conversation, and a row of depth 0 for each.

    The first turns of conversation c - c % FAMILY stand before what follows c's own
    first ones. A lender is joined to at most FAMILY conversations.
    """
    own = ordered.withColumn("_lent", lent(F.col("conv"))).withColumn("_lender", F.col("conv") - F.col("conv") % FAMILY)
    convs = own.select("conv", "_lent", "_lender").distinct()
    heads = ordered.where((F.col("conv") % FAMILY == 0) & (F.col("place") < HEADS))
    heads = heads.select(F.col("conv").alias("_lender"), F.col("place").alias("depth"), "t", "w")
    borrowed = convs.join(heads, "_lender").where(F.col("depth") <= F.col("_lent")).select("conv", "depth", "t", "w")
    sizes = heads.groupBy("_lender").agg(F.max("depth").alias("_size"))
    rest = own.where(F.col("place") > F.col("_lent")).join(sizes, "_lender", "left")
    taken = F.least(F.col("_lent"), F.coalesce(F.col("_size"), F.lit(0).cast("long")))
    rest = rest.select("conv", (F.col("place") - F.col("_lent") + taken).alias("depth"), "t", "w")
    top = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit("").alias("t"), F.lit(0).cast("long").alias("w"))
    return top.union(borrowed).union(rest)


def blocks(rebuilt: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row a conversation and block: prefix digests before and after it, its turns, words up to its end.

    The root, of depth 0 and digest 0, is a turn of the first block.
    """
    deep = F.col("depth") > 0
    digest = [F.when(deep, F.xxhash64("depth", "t", F.lit(salt))).otherwise(F.lit(0).cast("long")) for salt in (1, 2)]
    entry = F.struct("depth", "w", digest[0].alias("x"), digest[1].alias("y"))
    per_block = rebuilt.groupBy("conv", (F.greatest(F.col("depth") - 1, F.lit(0)) / block).cast("long").alias("k")).agg(
        F.sort_array(F.collect_list(entry)).alias("turns")  # at most block + 1
    )
    total = lambda part: F.aggregate(F.col("turns")[part], F.lit(0).cast("long"), lambda a, v: a.bitwiseXOR(v))
    words = F.aggregate(F.col("turns")["w"], F.lit(0).cast("long"), lambda a, v: a + v)
    totals = {"x1": ("bit_xor", total("x")), "y1": ("bit_xor", total("y")), "words": ("sum", words)}
    run = _running(per_block, "conv", [F.col("k")], totals)
    return run.select(
        "conv", "k", "turns", "x1", "y1", "words",
        F.col("x1").bitwiseXOR(total("x")).alias("x0"), F.col("y1").bitwiseXOR(total("y")).alias("y0"),
    )


#: What tells a distinct block: its place, the digests before and after, and its length.
KEY = ["k", "x0", "y0", "x1", "y1", "size"]


def _unfold(groups: DataFrame, *kept: Column) -> DataFrame:
    """The turns of distinct blocks as nodes: depth, digest (x, y), that of the parent (px, py), words, words from here to the block's end."""
    upto = lambda part, i: F.aggregate(F.slice(F.col("turns")[part], F.lit(1), i), F.lit(0).cast("long"), lambda a, v: a.bitwiseXOR(v))
    rest = lambda i: F.aggregate(F.slice(F.col("turns")["w"], i, F.size("turns")), F.lit(0).cast("long"), lambda a, v: a + v)
    node = lambda t, i: F.struct(
        t["depth"].alias("depth"), t["w"].alias("w"), t["x"].alias("tx"), t["y"].alias("ty"),
        F.col("x0").bitwiseXOR(upto("x", i + 1)).alias("x"), F.col("y0").bitwiseXOR(upto("y", i + 1)).alias("y"), rest(i + 1).alias("rest"),
    )
    each = groups.select(*kept, F.explode(F.transform("turns", node)).alias("n")).select(*[c for c in groups.select(*kept).columns], "n.*")
    return each.withColumn("px", F.col("x").bitwiseXOR(F.col("tx"))).withColumn("py", F.col("y").bitwiseXOR(F.col("ty"))).drop("tx", "ty")


def _nodes(groups: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Nodes of distinct blocks. Turns of a block without siblings are nodes as they stand; those of others are grouped.

    groups: distinct blocks with `alone`, `members`, `first` (smallest conversation).
    sums: columns over a group's turn that are added up over the groups of a node.
    """
    each = _unfold(groups, "*").select(
        "alone", "depth", "x", "y", "px", "py", "w", "first", "members", *(c.alias(n) for n, c in sums.items())
    )
    at = ["depth", "x", "y"]
    folded = each.where(~F.col("alone")).groupBy(*at).agg(
        F.min("px").alias("px"), F.min("py").alias("py"), F.min("w").alias("w"), F.min("first").alias("first"),
        F.sum("members").alias("members"), *(F.sum(n).alias(n) for n in sums),
    )
    return folded.unionByName(each.where("alone").drop("alone"))


def nodes(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row a node of the trie of rebuilt conversations; see the module's head and `op11`."""
    rebuilt = rebuild(store.land(turns(conversations), "turns"))
    cut = blocks(rebuilt, block).withColumn("size", F.size("turns"))
    totals = cut.groupBy("conv").agg(F.max("words").alias("all_words"), F.max("k").alias("last_k"))
    cut = cut.join(totals, "conv").withColumn("later", F.col("all_words") - F.col("words"))
    cut = store.land(cut.withColumn("last", F.col("k") == F.col("last_k")).drop("all_words", "last_k", "words"), "blocks")

    distinct = cut.groupBy(*KEY).agg(
        F.count("*").alias("members"), F.min("conv").alias("first"), F.sum("later").alias("later"),
        F.min("turns").alias("turns"), F.min_by("later", "conv").alias("later_first"),
    )
    distinct = store.land(distinct, "distinct")
    border = ["k", "x0", "y0"]
    shared = distinct.groupBy(*border).agg((F.count("*") == 1).alias("alone"))
    groups = store.land(distinct.join(shared, border), "groups")

    # Who owns what: the smallest member of each node, and whether a leaf is among its nodes.
    plain = store.land(_nodes(groups, {}), "nodes")
    below = plain.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y"))
    below = below.agg(F.count("*").alias("children"))
    plain = store.land(plain.join(below, ["depth", "x", "y"], "left").fillna(0, ["children"]), "nodes")
    owners = store.land(
        plain.groupBy(F.col("first").alias("conv")).agg(
            F.min("depth").alias("owned_from"), F.sum("w").alias("owned"), F.count_if(F.col("children") == 0).alias("leaf")
        ),
        "owners",
    )

    # Every owner counts in each block of its path; its own run is added turn by turn.
    held = cut.select("conv", *KEY).join(owners, "conv").groupBy(*KEY).agg(F.sum("owned").alias("held"), F.sum("leaf").alias("leaves"))
    run = owners.select(F.col("conv").alias("first"), "owned_from", F.col("owned").alias("own"))
    full = groups.join(held, KEY, "left").join(run, "first", "left").fillna(0, ["held", "leaves", "own"])
    full = store.land(full, "groups")
    in_own = F.coalesce(F.col("depth") >= F.col("owned_from"), F.lit(False))
    sums = {
        "words_all": F.col("later") + F.col("members") * F.col("rest"),
        "words_once": F.col("held") - F.col("own") + F.when(in_own, F.col("rest") + F.col("later_first")).otherwise(F.col("own")),
        "leaves": F.col("leaves"),
    }
    summed = _nodes(full, sums).select("depth", "x", "y", "words_all", "words_once", "leaves")

    ends = _ends(cut.where("last").select("conv", F.element_at("turns", -1)["depth"].alias("depth"), F.col("x1").alias("x"), F.col("y1").alias("y")))
    parents = plain.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("first").alias("parent_conv_id"))
    at = ["depth", "x", "y"]
    found = plain.join(summed, at).join(ends, at, "left")
    return found.join(parents, ["depth", "px", "py"], "left").select(
        F.col("first").alias("conv_id"), "depth", "parent_conv_id", F.col("members").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("words_all") - F.col("words_once")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def _ends(ends: DataFrame) -> DataFrame:
    """sha256 of the ids that end at each node, ascending and comma-joined, from pieces of bounded length."""
    spark = ends.sparkSession
    at = ["depth", "x", "y"]

    def rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                yield from zip(*(part.column(part.schema.get_field_index(n)).to_pylist() for n in names), strict=True)

    def packed(found: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [*at, "since", "ids"], [pa.int64()] * 4 + [pa.string()]
        node, since, ids, held, out = None, 0, [], 0, []
        for *now, conv in rows(batches, *at, "conv"):
            if node is not None and (now != node or held > PIECE):
                out.append((*node, since, ",".join(ids)))
                node = None
                if len(out) * 64 + held > 4 * PIECE:
                    yield packed(out, names, kinds)
                    out = []
            if node is None:
                node, since, ids, held = now, conv, [], 0
            ids.append(str(conv))
            held += len(ids[-1]) + 1
        if node is not None:
            out.append((*node, since, ",".join(ids)))
        if out:
            yield packed(out, names, kinds)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [*at, "ends_sha256"], [pa.int64()] * 3 + [pa.string()]
        node, made, out = None, None, []
        for *now, ids in rows(batches, *at, "ids"):
            if now == node:
                made.update(b"," + ids.encode())
                continue
            if node is not None:
                out.append((*node, made.hexdigest()))
                if len(out) >= 4096:
                    yield packed(out, names, kinds)
                    out = []
            node, made = now, hashlib.sha256(ids.encode())
        if node is not None:
            out.append((*node, made.hexdigest()))
        if out:
            yield packed(out, names, kinds)

    sorted_ids = ends.repartitionByRange(*at, "conv").sortWithinPartitions(*at, "conv")
    pieces = store.land(sorted_ids.mapInArrow(join, "depth long, x long, y long, since long, ids string"), "pieces")
    together = pieces.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *at).sortWithinPartitions(*at, "since")
    return together.mapInArrow(hashed, "depth long, x long, y long, ends_sha256 string")
