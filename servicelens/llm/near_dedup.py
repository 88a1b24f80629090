"""MinHash near-duplicates by an inverted join on pairs of signature coordinates.

1. Every document becomes its set of word shingles and a MinHash signature of
   64 coordinates.  Documents with equal sets share one *node*, so copies
   never meet each other in a join.
2. Two nodes match when they collide on at least ``MATCHES`` coordinates (at a similarity of
   0.8 a pair misses that with a probability of 4e-6).  Nodes are posted under tokens, the values of two
   neighbouring coordinates: two nodes that match have at least ``SHARED`` of them in common.  One value alone
   is that of a common shingle in many unlike texts, and the lists of these grow with
   the number of documents; two values at once seldom are.  Tokens that occur once
   are skipped, the others are ordered from rare to frequent, and a node is
   posted only under the first ones: two nodes with ``SHARED`` common tokens must
   meet in these prefixes.
3. A posting carries two bits of every coordinate.  Colliding coordinates agree
   in them, so counting agreements skips nearly all chance pairs at the join.
4. Lists of up to ``SMALL`` nodes are held against each other.  A longer list
   is not: its hub, the node in the most and longest lists, is held against
   the nodes that are not yet in the hub's component, and a list whose nodes are then all
   in one component is finished.  A group of near copies thus costs as many
   pairs as it has nodes.
   In the lists left over, every node is described by its differences from the hub, D(x),
   the shingles that only one of the two has.  Where a hub stands in another one's list and is like it, the
   other one takes its place (``leading_hubs``), so that a node is described about once and not for every hub.  With |x ^ y| = |D(x)| + |D(y)| - 2 |D(x) & D(y)|, a link of x and y
   asks for a number of common differences, and if x is not linked with the hub that number is never
   zero.  So nodes are posted under their rarest differences only
   (as many as the number asked for needs) and meet there: nodes that differ from the
   hub in other places never do, and no link is lost.
5. Surviving pairs are counted on the whole signatures and confirmed on the
   whole sets.  Components come from alternating large-star and small-star
   steps.  All intermediate tables are Parquet in the shared folder, and each is
   removed when the tables made from it stand.

The sets are made for nodes with a surviving pair or in a long list.  Their
ids are broadcast up to ``BROADCAST_IDS`` of them, beyond that the texts are
shuffled to them.

Defined results: null, empty and blank texts have an empty set and are linked
with nothing (own component, kept); a text with fewer words than the shingle
width is one shingle; repeated rows are copies of each other; of null ids
another member's id names the component, if there is one; empty tables give an
empty result; other columns are ignored.  A text of any length is hashed whole, in pieces; its set must
fit a task's memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelens.llm.shingles import SET_SCHEMA, SKETCH_SCHEMA, set_maker, sketcher
from servicelens.llm.text import free_name, keyed
from servicelens.plans.physical import discard, materialize

COORDINATES = 64
MATCHES = 36
SHARED = MATCHES - COORDINATES // 2  # pairs of neighbouring coordinates on which two matching nodes collide at least
SIMILARITY = 80  # per cent
WIDTH = 5  # words of a shingle
SMALL = 16  # nodes of a list whose pairs are all held against each other
SALTS = 16  # pieces of the nodes that are compared with one hub
BROADCAST_IDS = 500_000

POSTED = ["node", "n_shingles", "bits0", "bits1"]


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    rows = keyed(docs, id_col, text_col)
    id_type = rows.schema["__id"].dataType.simpleString()
    schema = SKETCH_SCHEMA.replace("__id long", f"__id {id_type}")
    return rows.mapInArrow(sketcher(width, COORDINATES), schema)


def pair_tokens(sig):
    """A signature's tokens: the values of two neighbouring coordinates, hashed with the pair's number."""
    pairs = F.sequence(F.lit(0), F.lit(COORDINATES // 2 - 1))
    return F.transform(pairs, lambda at: F.xxhash64(at, F.get(sig, 2 * at), F.get(sig, 2 * at + 1)))


def prefix_postings(nodes: DataFrame) -> DataFrame:
    """(token, node, n_shingles, bits): each node under the rarest of its shared tokens."""
    tokens = nodes.select("node", F.explode(pair_tokens("sig")).alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    by_node = (
        tokens.join(shared, "token")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
        .where(F.size("t") >= SHARED)
    )
    prefix = F.slice("t", F.lit(1), F.size("t") - (SHARED - 1))
    posted = by_node.select("node", prefix["token"].alias("tokens")).join(nodes.select(*POSTED), "node")
    return posted.select(F.explode("tokens").alias("token"), *POSTED)


def plausible(a, b, similarity: int):
    """Sizes and agreeing bit pairs allow the link; ``a`` and ``b`` give a posting's columns."""
    differing = a("bits0").bitwiseXOR(b("bits0")).bitwiseOR(a("bits1").bitwiseXOR(b("bits1")))
    return (
        100 * F.least(a("n_shingles"), b("n_shingles")) >= similarity * F.greatest(a("n_shingles"), b("n_shingles"))
    ) & (COORDINATES - F.bit_count(differing) >= MATCHES)


def short_list_pairs(postings: DataFrame, similarity: int) -> DataFrame:
    """Plausible pairs (a, b) of the lists of at most ``SMALL`` nodes; postings have the lists' ``size``."""
    lists = postings.where(F.col("size") <= SMALL).groupBy("token").agg(F.collect_list(F.struct(*POSTED)).alias("list"))
    each = lists.select("list", F.explode("list").alias("one"))
    partners = F.filter(
        "list", lambda p: (p["node"] > F.col("one.node")) & plausible(lambda c: F.col(f"one.{c}"), lambda c: p[c], similarity)
    )
    found = each.withColumn("partners", partners).select(F.col("one.node").alias("a"), F.col("partners.node").alias("bs"))
    return found.select("a", F.explode("bs").alias("b")).distinct()


def matching(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that collide on enough coordinates."""
    pairs = pairs.join(nodes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
    pairs = pairs.join(nodes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
    collisions = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda same: same))
    return pairs.where(collisions >= MATCHES).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose whole sets overlap enough."""
    pairs = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
    pairs = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    return pairs.where(100 * both >= similarity * union).select("a", "b")


def whole_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the wanted nodes; ``docs`` are keyed rows."""
    ids = nodes.join(wanted, "node", "left_semi").select(F.col("least.__id").alias("wanted_id")).distinct()
    ids = materialize(ids, "wanted")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")
    texts = docs.join(ids, docs["__id"].eqNullSafe(F.col("wanted_id")), "left_semi").select("__text")
    # an id may stand on several texts
    sets = texts.mapInArrow(set_maker(width), SET_SCHEMA)
    return materialize(sets.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "sets")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node
    that can be reached.  Alternating large-star and small-star steps."""
    edges = materialize(links.select(F.least("a", "b").alias("root"), F.greatest("a", "b").alias("node")).distinct(), "cc")
    while True:
        # finished when no node has two roots or is a root itself
        ends = edges.select(F.col("node").alias("id"), F.lit(1).alias("roots"), F.lit(0).alias("nodes")).unionByName(
            edges.select(F.col("root").alias("id"), F.lit(0).alias("roots"), F.lit(1).alias("nodes"))
        )
        ends = ends.groupBy("id").agg(F.sum("roots").alias("roots"), F.max("nodes").alias("nodes"))
        if ends.where("roots > 1 or (roots = 1 and nodes = 1)").agg(F.count("*")).first()[0] == 0:
            return edges
        # large star: larger neighbours move to the least node around
        both = edges.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(
            edges.select(F.col("root").alias("u"), F.col("node").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself do the same
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("node"), F.col("m").alias("root"))
        done = edges
        edges = materialize(small.unionByName(least.select(F.col("u").alias("node"), F.col("m").alias("root"))).distinct(), "cc")
        discard(done)


def hub_links(lists: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Links (a, b) between the lists' hubs and the nodes outside their components."""
    held = lists.where((F.col("root") != F.col("hub.root")) & plausible(F.col, lambda c: F.col(f"hub.{c}"), similarity))
    pairs = held.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()
    return confirmed(matching(pairs, nodes), sets, similarity)


def leading_hubs(lists: DataFrame, similarity: int) -> DataFrame:
    """(hub, leader) for every hub: the greatest hub of the lists that it stands in itself and that is plausibly like it.

    A group of near copies has many hubs, more of them the larger it is, and its nodes stand in lists of several.
    Differences from any one set tell two nodes apart, so these lists all take theirs from the leader.
    """
    alike = lists.where(plausible(F.col, lambda c: F.col(f"hub.{c}"), similarity))
    # every hub stands in its own lists
    greatest = alike.groupBy("node").agg(F.max(F.struct("hub.weight", "hub.node")).alias("greatest"))
    return greatest.select(F.col("node").alias("hub"), F.col("greatest.node").alias("leader"))


def differences(lists: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """One row per (hub, node) with the node's differences from the hub.

    With s = ``similarity``, x and y are linked if (100 + s) |x ^ y| <= (100 - s) (|x| + |y|).  ``excess`` is
    (100 + s) |D(x)| - (100 - s) |x|, so a link asks for 2 (100 + s) |D(x) & D(y)| >= excess(x) + excess(y), and x is
    linked with the hub itself (``near``) if its excess is at most (100 - s) |hub|.
    """
    own = [*POSTED, "root"]
    members = lists.select(F.col("hub.node").alias("hub"), F.col("hub.root").alias("hub_root"), *own).distinct()
    members = members.join(sets.select("node", "shingles"), "node").withColumn("salt", F.pmod(F.hash("node"), F.lit(SALTS)))
    # a hub may belong to a third of all nodes: its set goes to every salt
    hubs = lists.select(F.col("hub.node").alias("hub")).distinct()
    hubs = hubs.join(sets.select(F.col("node").alias("hub"), F.col("shingles").alias("of_hub")), "hub")
    hubs = hubs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = members.join(hubs, ["hub", "salt"])
    differing = F.concat(F.array_except("shingles", "of_hub"), F.array_except("of_hub", "shingles"))
    found = found.select("hub", "hub_root", *own, F.size("of_hub").cast("bigint").alias("n_hub"), differing.alias("diff"))
    found = found.withColumn("n_diff", F.size("diff").cast("bigint"))
    found = found.withColumn("excess", (100 + similarity) * F.col("n_diff") - (100 - similarity) * F.col("n_shingles"))
    near = F.col("excess") <= (100 - similarity) * F.col("n_hub")
    return found.withColumn("near", near).withColumn("odd", ~near & (F.col("root") != F.col("hub_root")))


def difference_postings(found: DataFrame, similarity: int) -> DataFrame:
    """(hub, element, node, at, ...): nodes under their rarest differences, ``at`` counted from the rarest.

    A node that may have to share k differences with a partner shares one of the
    first n_diff - k + 1.  Partners of odd nodes have an excess of at least -(100 - s) |hub|, and have k differences
    themselves; partners of the others are odd, with an excess of more than (100 - s) |hub|.
    """
    s, hub = similarity, (100 - similarity) * F.col("n_hub")
    of_odd = F.greatest(
        F.ceil((F.col("excess") - hub) / (2 * (100 + s))),
        F.ceil((F.col("excess") - F.floor((100 - s) * 100 * F.col("n_shingles") / s)) / (100 + s)),
    )
    asked = F.when(F.col("odd"), of_odd).otherwise(F.ceil((F.col("excess") + hub + 1) / (2 * (100 + s))))
    found = found.withColumn("n_posted", F.col("n_diff") + 1 - F.greatest(F.lit(1), asked))
    open_hubs = found.groupBy("hub").agg(F.max("odd").alias("any")).where("any").select("hub")
    elements = found.join(open_hubs, "hub", "left_semi").where("n_posted > 0")
    elements = elements.select("hub", "node", F.explode("diff").alias("element"))
    shared = elements.groupBy("hub", "element").agg(F.count("*").alias("df")).where("df > 1")
    # differences that nobody shares come first and need no posting
    order = elements.join(shared, ["hub", "element"]).groupBy("hub", "node")
    order = order.agg(F.sort_array(F.collect_list(F.struct("df", "element"))).alias("order"))
    facts = ["hub", *POSTED, "root", "odd", "n_diff", "excess", "n_posted"]
    posted = found.select(*facts).join(order, ["hub", "node"])
    alone = F.col("n_diff") - F.size("order")
    posted = posted.where(alone < F.col("n_posted"))
    first = F.slice("order", F.lit(1), F.least(F.size("order"), (F.col("n_posted") - alone).cast("int")))
    posted = posted.withColumn("alone", alone).select(*facts, "alone", F.posexplode(first).alias("k", "difference"))
    at = (F.col("alone") + F.col("k")).alias("at")
    return posted.select("hub", F.col("difference.element").alias("element"), at, *[c for c in facts if c != "hub"])


def difference_pairs(postings: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of different components, one of them odd, that can share as many differences as a link asks for."""
    key = ["hub", "element"]
    odd = postings.where("odd").select(*key, *[F.col(c).alias(f"other_{c}") for c in postings.columns if c not in key])
    asked = F.greatest(F.lit(1), F.ceil((F.col("excess") + F.col("other_excess")) / (2 * (100 + similarity))))
    held = (
        (F.col("root") != F.col("other_root"))
        & (~F.col("odd") | (F.col("node") < F.col("other_node")))
        & (F.col("at") + asked <= F.col("n_diff"))
        & (F.col("other_at") + asked <= F.col("other_n_diff"))
        & plausible(F.col, lambda c: F.col(f"other_{c}"), similarity)
    )
    pairs = postings.join(odd, (postings["hub"] == odd["hub"]) & (postings["element"] == odd["element"]) & held)
    return pairs.select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b")).distinct()


def linked_nodes(links: DataFrame, postings: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """(node, root) of all nodes with a link: those of ``links``, and those that
    the long lists (``postings``) add as far as components need them."""
    roots = components(links)
    # the original of many copies stands in more and longer lists than they do
    weights = postings.groupBy("node").agg(F.sum("size").alias("weight"))

    def joined(found: DataFrame, roots: DataFrame) -> DataFrame:
        return components(found.unionByName(roots.select(F.col("root").alias("a"), F.col("node").alias("b"))))

    def rooted(df: DataFrame) -> DataFrame:
        return df.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    # lists that join different components, with their hubs
    at = rooted(postings.drop("size").join(weights, "node"))
    hubs = at.groupBy("token").agg(
        F.max(F.struct("weight", *POSTED, "root")).alias("hub"), F.min("root").alias("one"), F.max("root").alias("two")
    )
    lists = materialize(at.join(hubs.where("one != two").select("token", "hub"), "token"), "lists")
    if lists.isEmpty():
        return roots
    before, roots = roots, joined(hub_links(lists, nodes, sets, similarity), roots)
    # lists whose other nodes still belong to different components, with their hubs' leading hubs
    own = rooted(lists.where("node != hub.node").select("token", F.col("hub.node").alias("hub"), *POSTED))
    still = own.groupBy("token").agg(F.first("hub").alias("hub"), F.min("root").alias("one"), F.max("root").alias("two"))
    led = still.where("one != two").join(leading_hubs(lists, similarity), "hub").select("token", F.col("leader").alias("node"))
    led = rooted(led).select("token", F.struct("node", "root").alias("hub"))
    found = materialize(differences(own.drop("hub").join(led, "token"), sets, similarity), "differences")
    discard(lists, before)
    near = found.where("near and root != hub_root").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
    posted = materialize(difference_postings(found, similarity), "postings")
    pairs = materialize(difference_pairs(posted, similarity), "pairs")
    links = confirmed(matching(pairs, nodes), sets, similarity)
    out = joined(links.unionByName(near), roots)
    discard(found, posted, pairs, roots)
    return out


def grouped_rows(docs: DataFrame, id_col: str, text_col: str, width: int, similarity: int) -> DataFrame:
    """One row per input row: __id, __text_hash, n_shingles, component_id, kept."""
    sketch = materialize(sketches(docs, id_col, text_col, width), "sketches")
    one = [F.first(c).alias(c) for c in ("n_shingles", "sig", "bits0", "bits1")]
    # the least row stays: least id (null last), then least text hash
    row = F.struct(F.col("__id").isNull().alias("no_id"), "__id", "__text_hash")
    nodes = sketch.where("node is not null").groupBy("node").agg(F.min(row).alias("least"), *one)
    nodes = materialize(nodes, "nodes")
    rows = materialize(sketch.select("__id", "__text_hash", "n_shingles", "node"), "rows")
    discard(sketch)
    prefixes = materialize(prefix_postings(nodes), "postings")
    sizes = prefixes.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    postings = prefixes.join(sizes, "token")
    pairs = materialize(matching(short_list_pairs(postings, similarity), nodes), "pairs")
    long_lists = materialize(postings.where(F.col("size") > SMALL).select("token", "size", *POSTED), "postings")
    discard(prefixes)
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(long_lists.select("node")).distinct()
    sets = whole_sets(keyed(docs, id_col, text_col), nodes, wanted, width)
    links = confirmed(pairs, sets, similarity)
    roots = linked_nodes(links, long_lists, nodes, sets, similarity)
    discard(pairs, long_lists, sets)
    named = nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.join(roots.select("root").distinct(), "root", "left_semi").groupBy("root").agg(F.min("least").alias("of_group"))
    named = named.join(least, "root", "left").select("node", F.coalesce("of_group", "least").alias("least"))
    out = rows.join(named, "node", "left")
    out = out.withColumn("component_id", F.coalesce("least.__id", "__id"))
    stays = F.col("__id").eqNullSafe(F.col("least.__id")) & (F.col("__text_hash") == F.col("least.__text_hash"))
    kept = F.col("node").isNull() | stays
    return out.select("__id", "__text_hash", "n_shingles", "component_id", kept.alias("kept"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: int = SIMILARITY
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (least id that can
    be reached over links, its own included), kept (id = component_id; of several
    texts with that id, the one with the least hash)."""
    rows = grouped_rows(docs, id_col, text_col, width, similarity)
    return rows.select(F.col("__id").alias(id_col), "n_shingles", "component_id", "kept")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: int = SIMILARITY
) -> DataFrame:
    """One row of each group of near-duplicates, columns unchanged: the one
    with the least id (of several texts with that id, the least text hash), and
    one of several rows equal in id and text.  Rows
    without words all stay."""
    found = materialize(grouped_rows(docs, id_col, text_col, width, similarity).where("n_shingles > 0"), "grouped")
    hashed = free_name(docs, "__hash_here")
    here = docs.withColumn(hashed, F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))

    def among(df, keys, how):
        match = df[f"`{id_col}`"].eqNullSafe(keys["__id"]) & (df[hashed] == keys["__text_hash"])
        return df.join(keys, match, how)

    key = ["__id", "__text_hash"]
    stays = among(here, found.where("not kept").select(*key).distinct(), "left_anti")
    copies = found.where("kept").groupBy(*key).agg(F.count("*").alias("k")).where("k > 1").select(*key)
    if not copies.isEmpty():
        copies = materialize(copies, "copies")
        one = among(stays, copies, "left_semi").dropDuplicates([id_col, hashed])
        stays = among(stays, copies, "left_anti").unionByName(one)
    return stays.drop(hashed)


def op6_query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=2)
