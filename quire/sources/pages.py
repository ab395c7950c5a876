"""Pages and bookmarks of files as a data source, read in shards of pages.

A backend opens a file and gives its number of pages, the text of a page and its bookmarks; ``BACKENDS`` names those there
are. The one at hand reads text files whose pages end with a form feed and whose bookmarks are lines that start with ``#``.
A file that can't be opened has no pages and no bookmarks, with a warning.

    spark.dataSource.register(PageSource)
    spark.read.format("quire_pages").option("path", folder).option("shard_pages", 20).load()
    spark.read.format("quire_pages").option("path", folder).option("table", "toc").load()
"""

from __future__ import annotations

import os
import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGES = "path string, page_idx int, text string, char_count int, is_scanned boolean"
TOC = "path string, toc_ord int, title string, level int, page_idx int"


class Backend(Protocol):
    suffix: str

    def __init__(self, path: str): ...

    def __enter__(self) -> Backend: ...

    def __exit__(self, *why: object) -> None: ...

    def __len__(self) -> int: ...

    def text(self, page: int) -> str: ...

    def bookmarks(self) -> Iterator[tuple[str, int, int | None]]: ...


class FormFeedText:
    """Text files whose pages end with a form feed. The file is read page by page; nothing of it is kept."""

    suffix = ".txt"

    def __init__(self, path: str):
        self.path = path
        self._starts: list[int] | None = None

    def __enter__(self) -> FormFeedText:
        self._file = open(self.path, "rb")  # noqa: SIM115
        return self

    def __exit__(self, *why: object) -> None:
        self._file.close()

    def _places(self) -> list[int]:
        if self._starts is None:
            self._starts, at, last = [0], 0, b""
            self._file.seek(0)
            while piece := self._file.read(1 << 20):
                self._starts += [at + i + 1 for i, c in enumerate(piece) if c == 12] if b"\f" in piece else []
                at, last = at + len(piece), piece
            if self._starts[-1] != at or not last:
                self._starts.append(at)
        return self._starts

    def __len__(self) -> int:
        return len(self._places()) - 1 if os.path.getsize(self.path) else 0

    def text(self, page: int) -> str:
        lo, hi = self._places()[page : page + 2]
        self._file.seek(lo)
        return self._file.read(hi - lo).decode("utf-8", "replace").removesuffix("\f")

    def bookmarks(self) -> Iterator[tuple[str, int, int | None]]:
        for page in range(len(self)):
            for line in self.text(page).split("\n"):
                if line.startswith("#"):
                    yield line.lstrip("#").strip(), len(line) - len(line.lstrip("#")) - 1, page


BACKENDS: dict[str, type] = {"text": FormFeedText}


def page_count(backend: type, path: str) -> int | None:
    """Pages of a file; None where it can't be opened."""
    try:
        with backend(path) as f:
            return len(f)
    except Exception as e:  # noqa: BLE001
        warnings.warn(f"{path}: {e}", stacklevel=2)
        return None


@dataclass
class Shard(InputPartition):
    path: str
    start: int
    end: int


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quire_pages"

    def schema(self) -> str:
        return TOC if self.options.get("table") == "toc" else PAGES

    def reader(self, schema) -> DataSourceReader:
        return PageReader(dict(self.options))


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.backend = BACKENDS[options.get("backend", "text")]
        self.root, self.toc = options["path"], options.get("table") == "toc"
        self.step = max(1, int(options.get("shard_pages") or 20))

    def partitions(self) -> list[Shard]:
        if os.path.isfile(self.root):
            paths = [self.root]
        else:
            paths = sorted(os.path.join(d, n) for d, _, names in os.walk(self.root) for n in names if n.endswith(self.backend.suffix))
        if self.toc:
            return [Shard(p, 0, 0) for p in paths] or [Shard("", 0, 0)]
        return [Shard(p, a, min(a + self.step, n)) for p in paths for n in [page_count(self.backend, p) or 0] for a in range(0, n, self.step)] or [Shard("", 0, 0)]

    def read(self, partition: Shard) -> Iterator[tuple]:
        if not partition.path:
            return
        if self.toc:
            yield from self._bookmarks(partition.path)
            return
        with self.backend(partition.path) as f:
            for i in range(partition.start, min(partition.end, len(f))):
                text = f.text(i)
                n = len(text.strip())
                yield partition.path, i, text if n else None, n, n == 0

    def _bookmarks(self, path: str) -> list[tuple]:
        """Bookmarks with a title; on page 0 where they name none; none at all where any of them fails."""
        try:
            with self.backend(path) as f:
                named = [(title, level, page or 0) for title, level, page in f.bookmarks() if title.strip()]
        except Exception as e:  # noqa: BLE001
            warnings.warn(f"{path}: {e}", stacklevel=2)
            return []
        return [(path, i, *x) for i, x in enumerate(named)]
