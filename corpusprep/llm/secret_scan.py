"""Secret scan: base patterns, and corpus-wide ownership frequency for what they leave open.

One pass over the whole texts finds the base matches (``assign``, ``access``, ``hex``) and
further candidates: bare tokens of 20 or more key characters that touch no base match.
A candidate's value is hashed (128 bits); hashes are counted over the whole corpus by
distinct repository (``repo_col``) and distinct owner (the repository's part before ``/``,
or an owner column). A value held by at most ``max_owners`` owners and ``max_repos``
repositories is owner-specific, one held by more is a widely copied example. An
owner-specific value that looks live (a letter, a digit, 10 or more different characters)
is a credential: bare ones become spans of kind ``live``; base spans stay whatever their
count, and ``n_live`` / ``n_copied`` tell what the counts say about them.

Counting is by (value, repository, owner) first, with map-side partials, so a value in a
third of all rows is a few rows per repository. Verdicts meet the places again by
``join_counted``: values with over 1/4096 of all places are broadcast (at most 4,096 of
them), the others are shuffled.

Defined results: a null or empty text has no span, and ``base_sha256`` of the empty
string; a null repository or owner counts as one repository or owner of its own; equal
rows are each reported and their places all count, but repeat no repository; other input
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import join_counted

# The base patterns, their least lengths, and the order of the kinds.
ASSIGN = (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "live")

#: Bare candidates: runs of key characters of at least this length.
BARE = r"[A-Za-z0-9+/_=-]+"
MIN_BARE = 20
#: What looks live: a letter, a digit, and so many different characters.
MIN_DIFFERENT = 10
#: Owner-specific: held by at most so many owners and repositories; above that a value is a widely copied example.
MAX_OWNERS, MAX_REPOS = 2, 3

_ASSIGN, _ACCESS, _HEX = re.compile(ASSIGN), re.compile(f"{ACCESS[:-1]}{{{MIN_ACCESS - 4},}}"), re.compile(f"{HEX[:-1]}{{{MIN_HEX},}}")
_BARE = re.compile(f"{BARE[:-1]}{{{MIN_BARE},}}")
_LETTER, _DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")

FOUND = ("n_assign long, n_access long, n_hex long, base_sha256 string, base array<string>, "
         "candidates array<struct<kind:int,start:int,end:int,value:binary,live:boolean>>")
_CANDIDATE = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.binary()), ("live", pa.bool_())])


def looks_live(value: str) -> bool:
    return bool(_LETTER.search(value) and _DIGIT.search(value)) and len(set(value)) >= MIN_DIFFERENT


def scan_text(text: str) -> tuple[list[tuple[int, int, int, str]], list[tuple[int, int, int, str]]]:
    """(base matches, bare candidates) of a whole text as (start, kind index, end, value), code points, in order."""
    base = [(m.start(), 0, m.end(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= MIN_ASSIGN]
    base += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    base.sort()
    bare, k, reach = [], 0, 0
    for m in _BARE.finditer(text):  # both lists go forward: a run is bare if no base match overlaps it
        while k < len(base) and base[k][0] < m.end():
            reach = max(reach, base[k][2])
            k += 1
        if reach <= m.start():
            bare.append((m.start(), 3, m.end(), m[0]))
    return base, bare


def _scan(batches: Iterator[pa.RecordBatch], carried: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "base", "candidates")}
        for text in batch.column("__text"):
            base, bare = scan_text(text.as_py() or "")
            spans = [f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in base]
            for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                out[name].append(sum(b[1] == k for b in base))
            out["base_sha256"].append(hashlib.sha256(",".join(spans).encode()).hexdigest())
            out["base"].append(spans)
            out["candidates"].append([{"kind": k, "start": s, "end": e, "value": hashlib.md5(v.encode()).digest(), "live": looks_live(v)}
                                      for s, k, e, v in base + bare if k < 3 or looks_live(v)])
        arrays = [batch.column(c) for c in carried]
        arrays += [pa.array(out[k], pa.int64()) for k in ("n_assign", "n_access", "n_hex")]
        arrays += [pa.array(out["base_sha256"]), pa.array(out["base"], pa.list_(pa.string())), pa.array(out["candidates"], pa.list_(_CANDIDATE))]
        yield pa.RecordBatch.from_arrays(arrays, names=carried + list(out))


def owner_of(repo: Column) -> Column:
    """The owner in a repository name: ``owner`` of ``owner/name``, or the whole name."""
    return F.regexp_extract(repo, r"^([^/]*)", 1)


def ownership(places: DataFrame) -> DataFrame:
    """Per value: places, distinct repositories and distinct owners, over the whole corpus (nulls count as one)."""
    once = places.groupBy("value", "repo", "owner").agg(F.count(F.lit(1)).alias("n"))
    distinct = lambda c: F.count_distinct(F.struct(c))  # noqa: E731  (a struct is never null, so nulls count)
    return once.groupBy("value").agg(F.sum("n").alias("n"), distinct("repo").alias("n_repos"), distinct("owner").alias("n_owners"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source",
                 owner_col: str | None = None, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied.

    ``spans`` holds every base span and the added ``live`` ones as kind:start:end, by start.
    ``n_live`` counts spans of either sort whose value is owner-specific and looks live,
    ``n_copied`` the candidates, base or bare, whose value is widely copied.
    """
    owner = F.col(owner_col) if owner_col else owner_of(F.col(repo_col))
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("__id"), F.col(repo_col).cast("string").alias("__repo"),
                       owner.cast("string").alias("__owner"), F.col(text_col).alias("__text"))
    carried = ["__row", "__id", "__repo", "__owner"]
    id_type = docs.schema[id_col].dataType.simpleString()
    found = materialize(rows.mapInArrow(lambda it: _scan(it, carried),
                                        f"__row long, __id {id_type}, __repo string, __owner string, {FOUND}"), "secrets")
    places = found.where(F.size("candidates") > 0).select("__row", F.col("__repo").alias("repo"), F.col("__owner").alias("owner"),
                                                          F.explode("candidates").alias("c")).select("__row", "repo", "owner", "c.*")
    counted = materialize(ownership(places), "ownership")
    judged = join_counted(places.select("__row", "kind", "start", "end", "value", "live"), counted, "value")
    own = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    live = own & F.col("live")
    span = F.when((F.col("kind") == 3) & live, F.struct(F.col("start"), F.col("kind"), F.concat_ws(":", F.lit("live"), "start", "end").alias("s")))
    per_row = judged.groupBy("__row").agg(F.collect_list(span).alias("added"), F.count_if(live).alias("n_live"),
                                          F.count_if(~own).alias("n_copied"))
    base = F.transform("base", lambda s: F.struct(F.split(s, ":")[1].cast("int").alias("start"),
                                                  F.array_position(F.array(*map(F.lit, KINDS)), F.split(s, ":")[0]).cast("int").alias("kind"), s.alias("s")))
    merged = F.when(F.size("added") > 0, F.array_join(F.array_sort(F.concat(base, "added"))["s"], ",")).otherwise(F.array_join("base", ","))
    return (found.drop("candidates").join(per_row, "__row", "left")
            .select(F.col("__id").alias(id_col), "n_assign", "n_access", "n_hex", "base_sha256", merged.alias("spans"),
                    F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"), F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied")))
