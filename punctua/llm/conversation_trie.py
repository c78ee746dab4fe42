"""Prefix trie of conversations by truncation peeling.

Every distinct beginning of a conversation is a node, named by a digest that is chained
from turn to turn. Peeling starts at the last turn: a conversation that ends carries what
its subtree is worth, loses its last turn, meets at the node left over the conversations
that ended there or came from other children, and so on to the root.

A round per depth would be a Spark job per turn of the longest conversation, and one beginning
may be common to a third of all conversations. So each conversation is peeled where it lies,
over its whole depth at once, and one regrouping by node merges what they carry. To count a
node once, it belongs to its smallest member. Such nodes are the lower end of a conversation's
path, as whoever is smallest at a node is smallest at all nodes below it on its own path;
above them the conversation only hands on what it carries. Work is linear in the turns, sums
are combined before the shuffle, and a task keeps one turn in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm.rows import column, new_folder, prepare_workers, written

NODE = 16  # bytes of a node's name; the root's is empty
ENDS = 10_000  # ids joined to one text on the way to a node's hash


def ordered_turns(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv, at, code, chars): the turns of each conversation, numbered from 1.

    ``code`` is a digest of role and text, ``chars`` counts the text's code points. Turns are
    ordered by ``turn``, null first; turns that tie by role, then by the digest. Null roles and
    texts count as empty. Rows without conversation id belong to none and are left out;
    repeated rows are turns of their own. Texts of any length are digested in place and not
    shuffled. Other columns are not read.
    """
    who, said = F.coalesce(column(role), F.lit("")), F.coalesce(column(text), F.lit(""))
    code = F.unhex(F.sha2(F.concat_ws(":", F.octet_length(who), who, said), 256))
    turns = df.filter(column(conv).isNotNull()).select(
        column(conv).cast("long").alias("conv"), column(turn).alias("turn"), who.alias("role"),
        code.alias("code"), F.char_length(said).cast("long").alias("chars"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "code")
    return turns.select("conv", F.row_number().over(order).alias("at"), "code", "chars")


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes along each conversation; ``more`` says that the conversation goes on."""
    schema = pa.schema(
        [("conv", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
         ("chars", pa.int64()), ("more", pa.bool_())]
    )
    last = None

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("conv", "code", "chars"))
        for conv, code, chars in zip(*columns, strict=True):
            goes_on = last is not None and last[0] == conv
            if last is not None:
                rows.append((*last, goes_on))
            if goes_on:
                node = hashlib.blake2b(last[2] + code, digest_size=NODE).digest()
                last = (conv, last[1] + 1, node, last[2], chars)
            else:
                last = (conv, 0, b"", None, 0)  # the first row of each conversation stands for the root
        if rows:
            yield made(rows)
    if last is not None:
        yield made([(*last, False)])


def _peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each conversation carries when it is cut back to a node, for all nodes of its path.

    Rows come by conversation, deepest first; of one depth the node's own row (``worth`` not
    null), if the conversation owns it, comes before that of the path.
    """
    conv, owner, carried, leaves = None, False, 0, 0
    for batch in batches:
        nodes, saved, childless = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("conv", "node", "worth", "leaf"))
        for of, node, worth, leaf in zip(*columns, strict=True):
            if of != conv:
                conv, owner, carried, leaves = of, worth is not None, 0, 0
            if worth is not None:
                carried += worth
                leaves += leaf
            elif owner:
                nodes.append(node)
                saved.append(carried)
                childless.append(leaves)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(saved, pa.int64()), pa.array(childless, pa.int64())],
            names=["node", "saved", "leaves"],
        )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one node that follow each other, as texts of up to ``ENDS`` ids."""
    node, ids = None, []

    def made(rows: list[tuple]) -> pa.RecordBatch:
        nodes, firsts, texts = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(firsts, pa.int64()), pa.array(texts, pa.string())],
            names=["node", "first", "ids"],
        )

    for batch in batches:
        rows = []
        for of, conv in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if ids and (of != node or len(ids) == ENDS):
                rows.append((node, ids[0], ",".join(map(str, ids))))
                ids = []
            node = of
            ids.append(conv)
        if rows:
            yield made(rows)
    if ids:
        yield made([(node, ids[0], ",".join(map(str, ids)))])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts, comma-joined in their order; no node's text is held whole."""
    node, running = None, None

    def made(rows: list[tuple]) -> pa.RecordBatch:
        nodes, sums = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array(sums, pa.string())], names=["node", "ends_sha256"]
        )

    for batch in batches:
        rows = []
        for of, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if running is not None and of == node:
                running.update(b"," + ids.encode())
                continue
            if running is not None:
                rows.append((node, running.hexdigest()))
            node, running = of, hashlib.sha256(ids.encode())
        if rows:
            yield made(rows)
    if running is not None:
        yield made([(node, running.hexdigest())])


def _ends(chains: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end.

    Many conversations may end at one node: their ids are sorted in as many tasks as ranges,
    only the hash of the sorted texts, which knows no other order, is one task's work.
    """
    ends = chains.filter("not more").select("node", "conv")
    ranged = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    texts = ranged.mapInArrow(_joined, "node binary, first bigint, ids string")
    sorted_texts = texts.repartition("node").sortWithinPartitions("node", "first")
    return sorted_texts.mapInArrow(_hashed, "node binary, ends_sha256 string")


def trie_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of ``turns`` (conv, at, code, chars) of the conversations ``convs`` (conv).

    One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, node. ``convs`` names each conversation once; those without turns
    end at the root. ``at`` orders the turns of one, with or without gaps. Without any
    conversation there is no node, not even the root.
    """
    prepare_workers(turns.sparkSession)
    folder = new_folder(turns, "conversation-trie")
    heads = convs.selectExpr("conv", "CAST(NULL AS INT) AS at", "CAST(NULL AS BINARY) AS code", "0L AS chars")
    steps = heads.unionByName(turns).repartition("conv")
    steps = steps.sortWithinPartitions("conv", F.col("at").asc_nulls_first())
    chains = steps.mapInArrow(
        _chain, "conv bigint, depth bigint, node binary, parent binary, chars bigint, more boolean"
    )
    chains = written(chains, folder, "chains")

    # parent, depth and chars follow from the node; as keys they keep this a hash aggregate
    nodes = chains.groupBy("node", "parent", "depth", "chars").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("more").alias("inner")
    )
    nodes = written(nodes, folder, "nodes")

    worth = ((F.col("n_convs") - 1) * F.col("chars")).alias("worth")
    owned = nodes.select("conv", "depth", "node", worth, (~F.col("inner")).cast("long").alias("leaf"))
    none = F.lit(None).cast("long")
    path = chains.select("conv", "depth", "node", none.alias("worth"), none.alias("leaf"))
    peeled = (
        owned.unionByName(path)
        .repartition("conv")
        .sortWithinPartitions("conv", F.col("depth").desc(), F.col("worth").asc_nulls_last())
        .mapInArrow(_peel, "node binary, saved bigint, leaves bigint")
    )
    zero = F.lit(0).cast("long")
    born = nodes.filter("parent IS NOT NULL").select(
        F.col("parent").alias("node"), zero.alias("saved"), zero.alias("leaves"), F.lit(1).cast("long").alias("children")
    )
    sums = peeled.withColumn("children", zero).unionByName(born).groupBy("node").agg(
        F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"), F.sum("children").alias("n_children")
    )
    whole = nodes.join(sums, "node").join(_ends(chains), "node", "left")
    whole = written(whole, folder, "whole")

    above = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    return whole.join(above, "parent", "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), "node",
    )


def conversation_trie(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per distinct beginning of the conversations of ``df``.

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs
    (conversations that begin so), n_children, n_leaves (childless nodes of the subtree, the
    node included), saved_tokens (summed over the subtree: (n_convs - 1) times the code points
    of a node's last text), ends_sha256 (of the ids, ascending and comma-joined, of those that
    end here), node (a digest, empty for the root).

    Nulls, ties, repeated rows and very long texts are as in ``ordered_turns``; an empty table
    gives no node. ``conv`` holds whole numbers; other columns are not read.
    """
    turns = written(ordered_turns(df, conv, turn, role, text), new_folder(df, "turns"), "turns")
    return trie_of(turns, turns.select("conv").distinct())


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of conversations that begin like the first of their hundred.

    Conversation c takes the first h turns of c - c % 100 (all if fewer, none if absent) and its
    own turns after its first h, where h is the CRC-32 of c as text modulo 6. ``turns`` is read
    several times and should be a written table.
    """
    taken = F.crc32(F.col("conv").cast("string")) % 6
    convs = turns.select("conv").distinct()
    first = turns.filter("conv % 100 = 0 AND at <= 5").withColumnRenamed("conv", "base")
    wanted = convs.select("conv", taken.alias("taken"), F.expr("conv - conv % 100").alias("base"))
    borrowed = wanted.join(first, "base").filter("at <= taken").select("conv", "at", "code", "chars")
    return turns.filter(F.col("at") > taken).unionByName(borrowed), convs
