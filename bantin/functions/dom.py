"""HTML pages as arrays of nodes, and native lookups over those arrays.

`page_nodes` is the only Python step: it turns markup into a flat node list. Selecting nodes,
reading their text and applying site rules are Spark expressions over that list.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bantin.functions.columns import as_column

# Executors get the page reader with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Tags that never have an end tag.
VOID_TAGS = set("area base br col embed hr img input keygen link menuitem meta param source track wbr".split())
# Pages are handed back once they have so many nodes or characters.
GROUP_NODES = 20_000
GROUP_CHARS = 2_000_000
_HIDDEN_TEXT = {"script", "style", "template"}
_KEEPS_SPACE = {"pre", "textarea"}

# A node covers nodes pos..last and the page text's bytes from t0 to t1: a place in bytes is found at
# once, one in characters only by reading all before it, for each node. `words` is the class attribute
# with one space around each word.
NODE_TYPE = T.StructType([
    T.StructField("pos", T.IntegerType()),
    T.StructField("last", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("ident", T.StringType()),
    T.StructField("cls", T.StringType()),
    T.StructField("words", T.StringType()),
    T.StructField("href", T.StringType()),
    T.StructField("src", T.StringType()),
    T.StructField("data_src", T.StringType()),
    T.StructField("datetime", T.StringType()),
    T.StructField("t0", T.IntegerType()),
    T.StructField("t1", T.IntegerType()),
])
PAGE_TYPE = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("nodes", T.ArrayType(NODE_TYPE)),
])
_ARROW_PAGE = pa.struct([
    ("text", pa.string()),
    ("nodes", pa.list_(pa.struct([
        (f.name, pa.int32() if isinstance(f.dataType, T.IntegerType) else pa.string()) for f in NODE_TYPE.fields
    ]))),
])


_FIELDS = [f.name for f in NODE_TYPE.fields]


class _Pages:
    """Pages read one after another into one list per node field, as Arrow wants them."""

    def __init__(self) -> None:
        self.fields: dict[str, list] = {name: [] for name in _FIELDS}
        self.ends, self.texts, self.length = [0], [], 0

    def read(self, html: str | None) -> None:
        self.length += len(html or "")
        self.texts.append(None if html is None else _PageReader(self.fields).page(html))
        self.ends.append(len(self.fields["pos"]))

    def array(self) -> pa.Array:
        node = _ARROW_PAGE.field("nodes").type.value_type
        columns = [pa.array(self.fields[f.name], f.type) for f in node]
        nodes = pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(node)))
        missing = pa.array([t is None for t in self.texts], pa.bool_())
        return pa.StructArray.from_arrays([pa.array(self.texts, pa.string()), nodes], fields=list(_ARROW_PAGE), mask=missing)


class _PageReader(HTMLParser):
    """Reads one page and adds its nodes to the lists. Counts per tag tell what is open, so that a
    page of unclosed tags takes no longer than any other."""

    def __init__(self, fields: dict[str, list]) -> None:
        super().__init__(convert_charrefs=True)
        self.fields = fields
        self.first = len(fields["pos"])
        self.open: list[tuple[str, int]] = []
        self.counts: Counter = Counter()
        self.text: list[str] = []
        self.length = 0
        self.pending: list[str] = []

    def handle_starttag(self, tag, attrs):
        self._flush()
        given = {name: value or "" for name, value in attrs}
        place = len(self.fields["pos"])
        node = {
            "pos": place - self.first, "last": place - self.first, "tag": tag,
            "ident": given.get("id"), "cls": given.get("class"),
            "words": f" {' '.join(given['class'].split())} " if "class" in given else None,
            "href": given.get("href"),
            "src": given.get("src"), "data_src": given.get("data-src"),
            "datetime": given.get("datetime"), "t0": self.length, "t1": self.length,
        }
        for name, values in self.fields.items():
            values.append(node[name])
        if tag not in VOID_TAGS:
            self.open.append((tag, place))
            self.counts[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._close()

    def handle_endtag(self, tag):
        self._flush()
        if self.counts[tag]:
            while self._close() != tag:
                pass

    def handle_data(self, data):
        self.pending.append(data)

    def _close(self) -> str:
        """Close the innermost open node."""
        tag, place = self.open.pop()
        self.counts[tag] -= 1
        self.fields["last"][place] = len(self.fields["pos"]) - 1 - self.first
        self.fields["t1"][place] = self.length
        return tag

    def _flush(self):
        if not self.pending:
            return
        data = "".join(self.pending)
        self.pending = []
        if any(self.counts[t] for t in _HIDDEN_TEXT):
            return
        # White space alone between tags counts as one line break or one space.
        if not data.strip(" \t\n\f\r") and not any(self.counts[t] for t in _KEEPS_SPACE):
            data = "\n" if "\n" in data else " "
        self.text.append(data)
        self.length += len(data) if data.isascii() else len(data.encode())

    def page(self, html: str) -> str:
        self.feed(html)
        self.close()
        self._flush()
        while self.open:
            self._close()
        return "".join(self.text)


def read_pages(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Pages to nodes, handed back in small groups: nodes take many times the room of their markup."""
    for pages in batches:
        found = _Pages()
        for page in pages:
            found.read(page.as_py())
            if found.ends[-1] >= GROUP_NODES or found.length >= GROUP_CHARS:
                yield found.array()
                found = _Pages()
        if found.texts:
            yield found.array()


def page_nodes(html) -> Column:
    """struct<text, nodes> of an HTML page; broken markup is read to its end."""

    @F.arrow_udf(PAGE_TYPE)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return read_pages(batches)

    return read(as_column(html))


# A selector step: `cls` must be the whole class attribute, or `word` one padded word of it.
STEP = "struct<tag:string,cls:string,word:string,ident:string>"


def step_of(tag: str | None = None, cls: str | None = None, ident: str | None = None) -> tuple:
    return (tag, cls, f" {cls} " if cls else None, ident)


# The lookups below give SQL text: a page needs dozens of them, and one parsed expression is
# much quicker to build than hundreds of Column calls. `nodes`, `step` and `within` are SQL too.

def _fits(step: str | None, tag: str | None) -> str:
    if tag is not None:
        return f"n.tag = '{tag}'"
    return (
        f"({step} is not null and ({step}.tag is null or n.tag = {step}.tag)"
        f" and ({step}.ident is null or n.ident = {step}.ident)"
        f" and ({step}.cls is null or n.cls = {step}.cls or contains(n.words, {step}.word)))"
    )


def find_all(nodes: str, step: str | None = None, tag: str | None = None, within: str | None = None) -> str:
    """Nodes that fit a selector step or have a tag, in page order; NULL parts of a step fit all.

    With `within` only nodes below that node count.
    """
    below = f"n.pos > {within}.pos and n.pos <= {within}.last and " if within else ""
    return f"filter({nodes}, n -> coalesce({below}{_fits(step, tag)}, false))"


def find(nodes: str, step: str | None = None, tag: str | None = None, within: str | None = None) -> str:
    """The first such node, else NULL."""
    return f"get({find_all(nodes, step, tag, within)}, 0)"


def find_path(nodes: str, path: str) -> str:
    """The node a selector path struct<outer, step, attribute> leads to."""
    return (
        f"case when {path}.outer is null then {find(nodes, f'{path}.step')}"
        f" else get(transform(array({find(nodes, f'{path}.outer')}),"
        f" o -> {find(nodes, f'{path}.step', within='o')}), 0) end"
    )


def node_text(text: str, node: str) -> str:
    """Text of the node and everything below it; give `text` as binary where many nodes are read."""
    return f"get(transform(array({node}), t -> cast(substring(cast({text} as binary), t.t0 + 1, t.t1 - t.t0) as string)), 0)"
