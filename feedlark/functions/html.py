"""Blocks of web pages."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# the parser travels with the task, so the workers need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without an end tag, and elements whose content is not page text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("script style template".split())


def flat_blocks(html: Column | str, tag: str, css_class: str | None = None) -> Column:
    """Inner HTML of every block that holds no block of its own kind, as array<string>."""
    attrs = rf' class="{css_class}"' if css_class else r"(?: [^>]*)?"
    return F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}{attrs}>(.*?)</{tag}>"), F.lit(1))


class _Blocks(HTMLParser):
    """Collects (data-id, text) of each `tag` element of a class, nested ones too, in page order."""

    def __init__(self, tag: str, css_class: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.css_class = tag, css_class
        self.found: list[tuple[str, list[str]]] = []
        self.path: list[tuple[str, list[str] | None]] = []  # open elements, and the block they start
        self.run: list[str] = []  # text since the last tag

    def _end_run(self):
        text = "".join(self.run).strip()
        self.run = []
        if text and not any(name in NO_TEXT for name, _ in self.path):
            for _, block in self.path:
                if block is not None:
                    block.append(text)

    def handle_starttag(self, tag, attrs):
        self._end_run()
        attrs = dict(attrs)
        block = None
        if tag == self.tag and self.css_class in (attrs.get("class") or "").split():
            block = []
            self.found.append((attrs.get("data-id") or "unknown", block))
        if tag not in VOID:
            self.path.append((tag, block))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_run()
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i][0] == tag:
                del self.path[i:]
                break

    def handle_data(self, data):
        self.run.append(data)

    def handle_comment(self, data):
        self._end_run()

    def close(self):
        super().close()
        self._end_run()


def nested_blocks(pages: DataFrame, key: str, html: str, tag: str = "div", css_class: str = "comment"):
    """One row per block: key, pos, id (`data-id` or "unknown"), text.

    For pages whose blocks nest or hold entities; `flat_blocks` is the native way for all others.
    """

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for page, source in zip(frame[key], frame[html]):
                parser = _Blocks(tag, css_class)
                parser.feed(source or "")
                parser.close()
                rows += [(page, i, bid, "".join(parts)) for i, (bid, parts) in enumerate(parser.found)]
            yield pd.DataFrame(rows, columns=[key, "pos", "id", "text"])

    key_type = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(extract, f"`{key}` {key_type}, pos int, id string, text string")
