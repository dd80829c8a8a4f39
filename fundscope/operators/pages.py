"""Page text and media flags from raw HTML.

``page_features`` parses each page once inside ``mapInArrow`` (parallel across
partitions; results leave in slices of bounded size) with the standard-library HTML parser. Definition:

- description: text of every ``<p>`` inside the container, joined with no
  separator; a ``<p>`` ends at ``</p>``, at the next ``<p>`` or at the end of
  the container (broken pages leave paragraphs open); text inside ``<script>``
  and ``<style>`` is never text; entities are decoded;
- has_image: a ``<figure>`` inside the container;
- has_video: a ``<video>`` anywhere on the page.

``page_flags`` is the regex-only subset (container, figure, video present),
pure Spark expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.functions.columns import has_text

# Container and media tags of the reference's pages; the driver pages use
# <article> as their container, so the container is a parameter.
REFERENCE_CONTAINER = ("div", "rte__content")
IMAGE_TAG = "figure"
VIDEO_TAG = "video"
SLICE_CHARS = 16 << 20          # text handed on at once

FEATURE_SCHEMA = ("page_id long, url string, description string, has_description int, "
                  "has_image int, has_video int")


class _PageParser(HTMLParser):
    def __init__(self, tag: str, cls: str | None):
        super().__init__(convert_charrefs=True)
        self.tag, self.cls = tag, cls
        self.depth = 0            # nesting depth of the container tag, 0 = outside
        self.done = False         # only the first container counts
        self.in_p = False
        self.skip = 0             # inside <script>/<style>
        self.parts: list[str] = []
        self.image = False
        self.video = False

    def _is_container(self, tag, attrs) -> bool:
        if tag != self.tag:
            return False
        if self.cls is None:
            return True
        classes = (dict(attrs).get("class") or "").split()
        return self.cls in classes

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        if tag == VIDEO_TAG:
            self.video = True
        if self.depth == 0:
            if not self.done and self._is_container(tag, attrs):
                self.depth = 1
            return
        if tag == self.tag:
            self.depth += 1
        if tag == "p":
            self.in_p = True
        elif tag == IMAGE_TAG:
            self.image = True

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.skip:
            self.skip -= 1
        if self.depth == 0:
            return
        if tag == "p":
            self.in_p = False
        elif tag == self.tag:
            self.depth -= 1
            if self.depth == 0:
                self.in_p = False
                self.done = True

    def handle_data(self, data):
        if self.depth and self.in_p and not self.skip:
            self.parts.append(data)


def parse_page(html: str | None, tag: str = "article", cls: str | None = None
               ) -> tuple[str, int, int]:
    """(description, has_image, has_video) of one page."""
    p = _PageParser(tag, cls)
    if html:
        p.feed(html)
        p.close()
    return "".join(p.parts), int(p.image), int(p.video)


def page_features(pages: DataFrame, container: str = "article", container_class: str | None = None,
                  id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
                  ) -> DataFrame:
    """``page_id, url, description, has_description, has_image, has_video``."""
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                       F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "description", "has_description", "has_image", "has_video"]
        for batch in batches:
            start, size, rows = 0, 0, []
            for i in range(batch.num_rows):
                rows.append(parse_page(batch.column(2)[i].as_py(), container, container_class))
                size += len(rows[-1][0])
                if size >= SLICE_CHARS or i == batch.num_rows - 1:
                    part = batch.slice(start, len(rows))
                    flags = [[int(bool(r[0].strip())) for r in rows], [r[1] for r in rows],
                             [r[2] for r in rows]]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array([r[0] for r in rows], pa.string()),
                         *[pa.array(f, pa.int32()) for f in flags]], names)
                    start, size, rows = i + 1, 0, []

    return src.mapInArrow(run, FEATURE_SCHEMA)


def page_flags(pages: DataFrame, container: str = "article", id_col: str = "page_id",
               html_col: str = "html") -> DataFrame:
    """T1 (regex subset): container present, figure inside it, video anywhere."""
    html = F.col(html_col)
    # the first container only, as page_features: up to its first end tag (no nesting)
    body = F.regexp_extract(html, rf"(?is)<{container}\b[^>]*>(.*?)(?:</{container}\s*>|$)", 1)
    return pages.select(
        F.col(id_col).alias("page_id"),
        html.rlike(rf"(?i)<{container}[\s>]").cast("int").alias("has_container"),
        body.rlike(rf"(?i)<{IMAGE_TAG}[\s>]").cast("int").alias("has_image"),
        html.rlike(rf"(?i)<{VIDEO_TAG}[\s>]").cast("int").alias("has_video"))


def pages_missing_text(features: DataFrame) -> DataFrame:
    """urls of pages with no description text."""
    return features.where(F.col("has_description") == 0).select("page_id", "url")


def description_flag(df: DataFrame, col: str = "description") -> DataFrame:
    """E14 on a table: ``HasDescription`` = any non-blank character."""
    return df.withColumn("HasDescription", has_text(col))
