"""Walks over a graph of folders: breadth first, each folder once, down to a depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketeer.functions.text import blank
from docketeer.sources.shared import written

#: How deep folders are followed.
MAX_DEPTH = 4


def walk(roots: DataFrame, edges: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node, depth, path, root) of all that roots (node, label) reach along edges (parent, child, name).

    A node counts once, at its least depth; path is the names on the way, the least by text where several ways are as
    short; root is where that way starts.  A round joins the frontier alone with the edges, takes one row a child before
    anything else moves, and leaves out what was visited; frontier and visited are written, so a round reads no lineage.
    Cycles and folders in many folders end by themselves.  Null nodes are left out; a root without a label has its own name.
    """
    start = roots.where("node is not null").select("node", F.lit(0).alias("depth"), F.array(F.coalesce("label", F.col("node").cast("string"))).alias("path"), F.col("node").alias("root"))
    frontier = visited = written(start.groupBy("node", "depth").agg(F.min(F.struct("path", "root")).alias("w")).select("node", "depth", "w.*"), "frontier")
    links = edges.where("parent is not null and child is not null").select("parent", "child", "name")
    for depth in range(1, max_depth + 1):
        onward = frontier.join(links, F.col("node") == F.col("parent"))
        best = onward.groupBy("child").agg(F.min(F.struct(F.concat("path", F.array(F.coalesce("name", F.lit("")))).alias("path"), F.col("root"))).alias("w"))
        new = best.select(F.col("child").alias("node"), F.lit(depth).alias("depth"), "w.path", "w.root")
        frontier = written(new.join(visited.select("node"), "node", "left_anti"), "frontier")
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited


# Words of file and folder names that are never, or likely, those of rulings.
NEVER = r"\b(civility|guidelines|pre[-_ ]?trial|checklist|standing case management)\b"
LIKELY = r"\b(tentative|ruling|rulings|probate|notes?|law\s*(?:&|and)\s*motion|guardianship|cmc)\b"


def likely_ruling(name: Column, folders: Column) -> Column:
    """Whether a file's name, or the names of the folders above it, say that it is a PDF file of rulings."""
    words = F.lower(F.concat_ws(" ", blank(name), F.array_join(folders, " ")))
    return F.endswith(F.lower(blank(name)), F.lit(".pdf")) & ~words.rlike(NEVER) & words.rlike(LIKELY)


def folder_items(html: Column) -> Column:
    """(id, name, kind) of what a folder's page lists, each once in order: its script holds an escaped JSON array, in
    which every array that has texts in its first, third and fourth places is an item.  Pages without one list none."""
    quoted = F.regexp_extract(blank(html), r"window\['_DRIVE_ivd'\]\s*=\s*'((?:\\.|[^'])*)'", 1)
    text = r'"((?:[^"\\]|\\.)*)"'
    plain = F.replace(F.replace(F.regexp_replace(quoted, r"\\x([0-9a-fA-F]{2})", "%$1"), F.lit("\\/"), F.lit("/")), F.lit("+"), F.lit("%2B"))
    decoded = F.try_url_decode(F.regexp_replace(plain, "%(?![0-9a-fA-F]{2})", "%25"))
    second = r'(?:"(?:[^"\\]|\\.)*"|\[[^\[\]]*\]|[^,\[\]"]*)'
    pattern = rf"\[\s*{text}\s*,\s*{second}\s*,\s*{text}\s*,\s*{text}"
    found = F.regexp_extract_all(F.coalesce(decoded, F.lit("")), F.lit(pattern), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.struct(*(F.regexp_extract(x, pattern, i).alias(name) for i, name in ((1, "id"), (2, "name"), (3, "kind"))))))
