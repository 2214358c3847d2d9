"""The main text of web pages, by a conditional random field over their leaf blocks.

Features of a block are its own element, all tags on the way up and the words of their classes, ids
and roles, and how its text looks: length, share of links, marks at its end, capitals, figures. The
field is fitted on labelled pages (:mod:`labelled_pages`, ``PAGES`` of them, a fixed set that does not
depend on the data) and decoded by Viterbi, page by page, in the tasks that read them.

Defined results: a NULL or empty page, or one without an article, has the empty text. White space is
that of Unicode, so no-break spaces count. Markup that never ends goes with the rest of the page, as
the HTML standard has it. Columns named like those added are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from grantlens.llm import crf
from grantlens.llm.common import small_batches
from grantlens.llm.html_blocks import Block, leaf_blocks
from grantlens.llm.labelled_pages import labelled_pages

#: Labelled pages that the field is fitted on.
PAGES = 600
LENGTHS = (1, 2, 4, 8, 15, 30, 60)
#: Words at the head of a block that say what follows.
HINTS = frozenset(
    "cookie cookies comment comments reply responses discussion share privacy copyright subscribe newsletter sponsored advertisement "
    "kommentare commentaires comentarios".split()
)
FIGURE = re.compile(r"\d")


def text_features(block: Block) -> set[str]:
    """How the text of a block looks, and its own element."""
    text = block.text
    found = {"bias", "own:" + block.tag, f"length:{bisect_right(LENGTHS, text.count(' ') + 1)}"}
    share = block.linked
    found.add("links:" + ("none" if not share else "few" if share < 0.3 else "many" if share < 0.95 else "all"))
    end = text[-1]
    found.add("end:" + ("sentence" if end in ".!?…。" else "clause" if end in ",;:" else "other"))
    if "©" in text[:200] or "(c)" in text[:200].lower():
        found.add("owner")
    if text.isupper():
        found.add("capitals")
    if FIGURE.search(text, 0, 200):
        found.add("figures")
    if "," in text:
        found.add("commas")
    found.update("hint:" + word for word in {word.strip(".:,!?()").lower() for word in text.split(" ", 12)[:12]} & HINTS)
    return found


def step_kinds(blocks: Sequence[Block]) -> list[int]:
    """Whether each block stands in the same element as the one before."""
    return [0, *(int(a.parent == b.parent) for a, b in zip(blocks, blocks[1:], strict=False))]


def labelled(page: str) -> tuple[list[set[str]], list[int], list[int]]:
    blocks = leaf_blocks(page)
    features = [text_features(block) | {name for name in block.names if name[0] != "@"} for block in blocks]
    labels = [int("@main" in block.names and "@not" not in block.names) for block in blocks]
    return features, step_kinds(blocks), labels


@cache
def fitted(pages: int = PAGES) -> crf.Chain:
    """The field fitted on the labelled pages; a few seconds, once per driver."""
    return crf.fit([labelled(page) for page in labelled_pages(pages)])


class Reader:
    """Takes pages apart with one fitted field; the score of a way up is kept."""

    def __init__(self, chain: crf.Chain) -> None:
        self.chain, self.weights = chain, chain.weights
        self.known = frozenset(name for name in chain.weights if name.startswith(("in:", "word:")))
        self.above: dict[frozenset[str], float] = {}

    def score(self, block: Block) -> float:
        above = self.above.get(block.names)
        if above is None:
            if len(self.above) > 100_000:
                self.above.clear()
            # in one order, as sums of floats depend on it
            above = self.above[block.names] = sum(self.weights[name] for name in sorted(block.names))
        return above + sum(self.weights.get(name, 0.0) for name in sorted(text_features(block)))

    def main_blocks(self, page: str) -> list[Block]:
        blocks = leaf_blocks(page, self.known)
        labels = crf.decode([self.score(block) for block in blocks], step_kinds(blocks), self.chain)
        return [block for block, label in zip(blocks, labels, strict=True) if label]

    def main_text(self, page: str) -> str:
        return "\n\n".join(block.text for block in self.main_blocks(page))


def extract(pages: DataFrame, html: str = "html", chain: crf.Chain | None = None) -> DataFrame:
    """``pages`` without ``html``, with the main ``text`` of each and its length ``n_chars``."""
    chain = fitted() if chain is None else chain
    kept = pages.drop("text", "n_chars")
    kept = kept.select(*[name for name in kept.columns if name != html], html)
    names = [*kept.columns[:-1], "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(chain)
        for batch in small_batches(batches):
            texts = [reader.main_text(page or "") for page in batch.columns[-1].to_pylist()]
            lengths = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), lengths], names)

    schema = StructType([*kept.schema.fields[:-1], StructField("text", StringType()), StructField("n_chars", LongType())])
    return kept.mapInArrow(run, schema)
