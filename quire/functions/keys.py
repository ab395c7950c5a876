"""Content-addressed keys as column expressions."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import text as T


def stage_key(stage: str, version: str, params: dict[str, Any], inputs: Column) -> Column:
    """16 hex digits that change with the stage, its version, its parameters and the hashes of its inputs, in any order of
    the latter. ``inputs`` is an array; chaining the keys of earlier stages as inputs carries their changes on."""
    head = "|".join((stage, version, json.dumps(params, sort_keys=True, separators=(",", ":"))))
    return F.substring(F.sha2(F.concat_ws("|", F.lit(head), F.array_join(F.array_sort(inputs), "|")), 256), 1, 16)


def book_dir(sha: Column) -> Column:
    return F.substring(sha, 1, 12)


def block_key(sha: Column, page: Column, block: Column) -> Column:
    return F.concat(book_dir(sha), F.format_string("_p%04d_b%03d", page, block))


def node_key(sha: Column, text: Column, page: Column, box: Column, kind: Column, grid: int = 8) -> Column:
    """``n_`` and eight hex digits of a node: its book, the start of its text, its page, its box on a grid and its type, so
    that small shifts of the box change nothing."""
    corners = F.array_join(F.transform(box, lambda v: (F.bround(v / grid) * grid).cast("bigint").cast("string")), ", ")
    parts = (book_dir(sha), T.strip(F.substring(text, 1, 80)), page.cast("string"), F.concat(F.lit("("), corners, F.lit(")")), kind)
    return F.concat(F.lit("n_"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 8))


def chunk_key(slug: Column, chapter: Column, section: Column, number: Column, text: Column) -> Column:
    """The book's slug, two digits of chapter and section, four of the chunk, and six hex digits of its text."""
    return F.concat(slug, F.format_string("_%02d_%02d_%04d_", chapter, section, number), F.substring(F.sha2(text, 256), 1, 6))


def book_slug(title: Column, sha: Column) -> Column:
    """A readable name of a book: its title and six hex digits, or twelve where the title has no letter or digit."""
    safe = T.slug(title)
    return F.when(safe != "", F.concat(safe, F.lit("_"), F.substring(sha, 1, 6))).otherwise(book_dir(sha))
