"""A Merkle manifest of a dataset: every row a leaf, every node an interval of leaf ranks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import register, table, written

RUN = 3  # consecutive nodes that become one

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field_form(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` when missing, else its length in bytes, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return _hash(*[field_form(v) for v in values])


def ranked_leaves(leaves: DataFrame, name: str) -> DataFrame:
    """``leaves`` (``tree, ord, leaf``, other columns kept) with ``lo`` = ``hi`` = rank within the tree and ``n``, the tree's leaves.

    Order is by ``ord``, then ``leaf``, then as read; leaves alike in both are interchangeable. Ranges of the whole order
    go to partitions, a large tree to many; ranks come from the rows of each tree per partition, summed over the partitions
    before. The sorted rows are written, so that ranges and positions belong together even when a task is run again.
    """
    dealt = leaves.withColumn("__read", F.monotonically_increasing_id())
    order = ["tree", "ord", "leaf", "__read"]
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).drop("__read")
    place = F.monotonically_increasing_id()
    dealt = written(dealt.withColumns({"part": F.shiftright(place, 33).cast("int"), "place": place}), name)
    # One row per partition and tree: partitions + trees of them at most.
    parts = dealt.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    by_tree = Window.partitionBy("tree")
    before = F.sum("rows").over(by_tree.orderBy("part")) - F.col("rows")
    parts = written(
        parts.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(by_tree).alias("n")), f"{name}_parts"
    )
    rank = (F.col("place") + F.col("shift")).alias("lo")
    kept = [c for c in dealt.columns if c not in ("part", "place")]
    joined = dealt.join(parts, ["tree", "part"])
    return joined.select(*kept, rank, rank.alias("hi"), "n")


_PATH = "array<struct<before:string,after:string>>"


def ascend(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The nodes of every level, leaves first: ``tree, n, lo, hi, digest`` and, above the leaves, their ``children``.

    A node covers the leaves ``lo`` to ``hi``; on level k a run's bucket is ``lo`` divided by RUN to the k. A level is built
    from the one below it by one grouping of at most RUN rows a key, and written, since it is read twice.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels, width = [leaves.withColumnRenamed("leaf", "digest")], 1
    while width < largest:
        nodes = levels[-1].where(F.col("n") > width)
        width *= RUN
        runs = nodes.groupBy("tree", "n", F.floor(F.col("lo") / width).alias("bucket")).agg(
            F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children")
        )
        digest = _hash(F.array_join(F.col("children.digest"), ""))
        runs = runs.select("tree", "n", F.array_min("children.lo").alias("lo"), F.array_max("children.hi").alias("hi"), digest.alias("digest"), "children")
        levels.append(written(runs, f"{name}_{len(levels)}"))
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """The topmost node of every tree: ``tree, digest``."""
    found = [nodes.where(F.col("n") <= RUN**level).select("tree", "digest") for level, nodes in enumerate(levels)]
    return reduce(DataFrame.unionByName, found)


def descend(levels: list[DataFrame], starts: DataFrame) -> DataFrame:
    """The leaves, each with the siblings on its way up as ``path`` and what ``starts`` (``tree, path, ...``) says of its tree.

    From the top down, a level's nodes are joined to the node above whose interval holds theirs: both stand in the same bucket
    of the upper level. Of that node's children those with another interval are the siblings. A path begins with the
    node's own level and ends with the path of its tree.
    """
    told = [c for c in starts.columns if c not in ("tree", "path")]
    above = None
    for level in range(len(levels) - 1, -1, -1):
        nodes = levels[level]
        here = nodes.where(F.col("n") <= RUN**level).join(starts, "tree")
        if above is not None:
            width = RUN ** (level + 1)
            bucket = lambda lo: F.floor(lo / width)
            upper = above.select(F.col("tree").alias("u_tree"), F.col("lo").alias("u_lo"), F.col("hi").alias("u_hi"), F.col("children").alias("u_children"), F.col("path").alias("u_path"), *told)
            inner = nodes.where(F.col("n") > RUN**level).join(
                upper,
                (F.col("tree") == F.col("u_tree")) & (bucket(F.col("lo")) == bucket(F.col("u_lo")))
                & (F.col("u_lo") <= F.col("lo")) & (F.col("hi") <= F.col("u_hi")),
            )

            def digests(left: bool) -> Column:
                others = F.filter("u_children", lambda c: c["hi"] < F.col("lo") if left else c["lo"] > F.col("hi"))
                return F.array_join(others["digest"], "")

            step = F.struct(digests(True).alias("before"), digests(False).alias("after"))
            inner = inner.withColumn("path", F.concat(F.array(step), F.col("u_path")).cast(_PATH))
            here = here.unionByName(inner.select(here.columns))
        above = here
    return above


def proof_text(path: Column) -> Column:
    """The digests of the siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda digest, step: _hash(step["before"], digest, step["after"]))


def manifest(rows: DataFrame, name: str = "manifest") -> DataFrame:
    """Every leaf with its place below the root: the columns of ``rows``, ``subroot``, ``root`` and ``path``.

    ``rows`` has ``tree`` (text, not NULL), ``ord`` and ``leaf`` (a digest); other columns are handed on, whatever their names, but
    for those that the result names itself. Leaves of a tree ascend by ``ord`` (NULL first), then by digest; every RUN
    consecutive nodes, the last run fewer, become their hash, until one is left, and the topmost nodes, ordered by tree, become
    the root alike. ``path`` holds a struct (``before``, ``after``) of siblings' digests per level.

    Repeated rows are leaves of their own. An empty table gives an empty result. A tree with most of the rows is dealt by
    ranges of its order, and runs of a level by their bucket, so none of it meets in one task.
    """
    own = ("tree", "ord", "leaf", "subroot", "root", "path")
    others = [c for c in rows.columns if c not in own]
    carried = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(None).cast("int")
    leaves = ranked_leaves(rows.select("tree", "ord", "leaf", carried.alias("carried")), f"{name}_leaves")
    levels = ascend(leaves, f"{name}_level")
    subroots = written(tops(levels), f"{name}_subroots")
    ranked = ranked_leaves(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("ord"), F.col("digest").alias("leaf")), f"{name}_trees")
    upper = ascend(ranked, f"{name}_upper")
    whole = tops(upper).select("tree", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    starts = descend(upper, whole).select(F.col("ord").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    found = descend(levels, written(starts, f"{name}_starts"))
    kept = [F.col(f"carried.`{c}`") for c in others]
    return found.select("tree", "ord", F.col("digest").alias("leaf"), "subroot", "root", "path", *kept)


def tree_of(source: Column) -> Column:
    """A text per source that orders as sources do, a missing one first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, tree, ord, leaf`` of documents, and ``changed``, the leaf of a copy whose text has lost its line feeds.

    Only documents whose checksum of the id is even are changed; the others, and those without an id, keep their leaf.
    NULL in any column is hashed as missing, which differs from an empty text.
    """
    fields = [F.col(f) for f in FIELDS]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaf = leaf_hash(fields)
    changed = F.when(even & F.contains("text", F.lit("\n")), leaf_hash([*fields[:-1], tampered])).otherwise(leaf)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), tree_of(F.col("source")).alias("tree"), F.col("doc_id").cast("bigint").alias("ord"), leaf.alias("leaf"), changed.alias("changed"))


@register("""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, doc_id::VARCHAR AS d, source, lang, n_chars::VARCHAR AS c, text,
         list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda e, f: CASE WHEN e & 1 = 1 THEN xor(e >> 1, 3988292384) ELSE e >> 1 END)) & 1 = 1 AS even
  FROM documents
), hashed AS (
  SELECT doc_id, tree, even, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(less)::VARCHAR || ':' || less, '-')) AS changed
  FROM (SELECT *, CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS less,
          coalesce(strlen(d)::VARCHAR || ':' || d, '-') || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
          || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') || coalesce(strlen(c)::VARCHAR || ':' || c, '-') AS head
        FROM docs)
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM hashed
), nodes AS (
  SELECT 0 AS level, tree, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT level + 1, tree, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY level, tree, pos // 3, n
), subroots AS (
  SELECT tree, level AS depth, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY level, pos // 3, n
), runs AS (
  SELECT tree, level, pos // 3 AS run, list(digest ORDER BY pos) AS kids FROM nodes WHERE n > 1 GROUP BY ALL
), upper_runs AS (
  SELECT level, pos // 3 AS run, list(digest ORDER BY pos) AS kids FROM upper WHERE n > 1 GROUP BY ALL
), steps AS (
  SELECT l.doc_id, l.pos AS leaf_at, l.tree, r.level AS step, l.pos // (3 ** r.level)::BIGINT % 3 AS place, kids
  FROM leaves l JOIN runs r ON r.tree = l.tree AND r.run = l.pos // (3 ** (r.level + 1))::BIGINT
  UNION ALL
  SELECT l.doc_id, l.pos, l.tree, s.depth + r.level, s.pos // (3 ** r.level)::BIGINT % 3, kids
  FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN upper_runs r ON r.run = s.pos // (3 ** (r.level + 1))::BIGINT
), sides AS (
  SELECT doc_id, leaf_at, tree, step, array_to_string(kids[:place], '') AS before, array_to_string(kids[place + 2:], '') AS after FROM steps
), folds AS (
  SELECT 0 AS step, tree, pos AS leaf_at, changed AS digest FROM leaves
  UNION ALL
  SELECT f.step + 1, f.tree, f.leaf_at, sha256(s.before || f.digest || s.after)
  FROM folds f JOIN sides s ON s.tree = f.tree AND s.leaf_at = f.leaf_at AND s.step = f.step
), proofs AS (
  SELECT tree, leaf_at, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256 FROM sides GROUP BY ALL
)
SELECT l.doc_id, l.leaf, s.subroot, u.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
       f.digest AS folded_root, f.digest = u.digest AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN upper u ON u.n = 1
LEFT JOIN proofs p ON p.tree = l.tree AND p.leaf_at = l.pos
JOIN (SELECT tree, leaf_at, digest FROM folds QUALIFY row_number() OVER (PARTITION BY tree, leaf_at ORDER BY step DESC) = 1) f
  ON f.tree = l.tree AND f.leaf_at = l.pos
""")
def op13_merkle_manifest(spark, sf_dir):
    """The manifest of all documents, and each checked against a copy that may have been tampered with."""
    leaves = manifest(document_leaves(table(spark, sf_dir, "documents")))
    root = folded(F.col("changed"), F.col("path"))
    proof = F.sha2(proof_text(F.col("path")), 256)
    out = leaves.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
