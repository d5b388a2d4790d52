"""Text blocks of an HTML page.

Finding the outermost text tags needs a stack of open tags, which no built-in expression
keeps; so this is the one Arrow UDF of the package. It sees one page at a time.
"""

from __future__ import annotations

import html as _html
import html.entities
import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags whose text is a block of its own.
BLOCK_TAGS = ("p", "span", "h1", "h2", "h3", "h4", "h5", "h6")

# HTML tags that have no content and so are never left open.
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex",
    "keygen", "menuitem", "nextid", "spacer",
)

# Tags whose strings do not count as text.
SILENT_TAGS = ("script", "style", "template", "rt", "rp")

# Start tags that end an open paragraph under HTML5 rules.
ENDS_PARAGRAPH = (
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
)


class _BlockFinder(HTMLParser):
    def __init__(self, html5: bool):
        super().__init__(convert_charrefs=False)
        self.html5 = html5
        self.open: list[str] = []
        self.silent = 0
        self.block_depth = 0  # stack height at which the current block was opened
        self.pending: list[str] = []
        self.text: list[str] = []
        self.blocks: list[str] = []

    def _flush(self):
        if self.pending:
            chunk = "".join(self.pending)
            self.pending.clear()
            # white space alone counts as one character: the line break, if there is one
            if not chunk.strip(" \n\t\f\r") and "pre" not in self.open and "textarea" not in self.open:
                chunk = "\n" if "\n" in chunk else " "
            if self.block_depth and not self.silent:
                self.text.append(chunk)

    def _close_to(self, depth: int):
        """Pop the stack of open tags down to `depth`."""
        self.silent -= sum(t in SILENT_TAGS for t in self.open[depth:])
        del self.open[depth:]
        if self.block_depth and depth < self.block_depth:
            self.blocks.append("".join(self.text))
            self.text.clear()
            self.block_depth = 0

    def _close_last(self, tag: str):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i] == tag:
                self._close_to(i)
                return

    def handle_starttag(self, tag, attrs):
        self._flush()
        if self.html5 and tag in ENDS_PARAGRAPH:
            self._close_last("p")
        if tag in VOID_TAGS:
            return
        self.open.append(tag)
        self.silent += tag in SILENT_TAGS
        if tag in BLOCK_TAGS and not self.block_depth:
            self.block_depth = len(self.open)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        if tag not in VOID_TAGS:
            self._close_last(tag)

    def handle_data(self, data):
        self.pending.append(data)

    def handle_entityref(self, name):
        self.pending.append(html.entities.html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        self.pending.append(_html.unescape(f"&#{name};"))

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def finish(self) -> list[str]:
        self.close()
        self._flush()
        self._close_to(0)
        return self.blocks


def page_blocks(page: str | None, html5: bool = False) -> list[str] | None:
    """Blocks of one page; None if the page cannot be parsed."""
    if not page:
        return []
    try:
        finder = _BlockFinder(html5)
        finder.feed(page)
        return finder.finish()
    except Exception:  # noqa: BLE001 - one broken page must not fail the job
        return None


def blocks(html_col: Column, mode: str = "tree") -> Column:
    """ARRAY<STRING> of block texts; NULL for a page that cannot be parsed.

    `tree` keeps a paragraph open until its own end tag or that of a tag around it;
    `html5` also ends it where the next block-level tag starts.
    """
    if mode not in ("tree", "html5"):
        raise ValueError(f"unknown mode {mode!r}")
    html5 = mode == "html5"

    @F.pandas_udf("array<string>")
    def find_blocks(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: page_blocks(page, html5))

    # the dearest step of a page: marked so that the planner does not work it out again for each filter above it
    return find_blocks.asNondeterministic()(html_col)


# Workers need no copy of the package: this module's functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
