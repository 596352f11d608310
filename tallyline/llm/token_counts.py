"""Token counts of sections by offset-mapped attribution.

A document is encoded whole, once; every token has a span of characters. The
sections are spans of characters too, and each token is given to the section
its span falls into, found by an interval join of the two sorted lists. A
token that crosses a boundary goes by the rule chosen:

* ``start``: to the section that holds its first character (the default);
* ``end``: to the section that holds its last character;
* ``most``: to the section that holds most of its characters, the first of equals.

Counting sections apart would not give the same: cut text merges differently.
Tokens of one character share its span, and go to its section.

Sections are the lines of a text, with their line ends, or what ``cut`` gives.
Counts of all sections add up to the document's.

Nulls and ties: a null or empty text has no section and no token; repeated rows
each get their counts; columns other than the id and text are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import table
from tallyline.llm.vocabulary import encoder

RULES = ("start", "end", "most")


def line_ends(text: str) -> np.ndarray:
    """Where each line ends, its line end included."""
    ends = np.cumsum([len(line) + 1 for line in text.split("\n")])
    ends[-1] -= 1
    return ends[:-1] if text.endswith("\n") else ends


def attribute(spans: np.ndarray, ends: np.ndarray, rule: str = "start") -> tuple[np.ndarray, int]:
    """Tokens of each section, and how many tokens cross a boundary. ``ends``: ascending ends of sections from 0 on."""
    first = np.searchsorted(ends, spans[:, 0], "right")
    last = np.searchsorted(ends, np.maximum(spans[:, 1] - 1, spans[:, 0]), "right")
    crossing = int((first != last).sum())
    if rule == "end":
        own = last
    elif rule == "most":
        own = first.copy()
        for i in np.flatnonzero(first != last):
            bounds = np.clip(np.concatenate([[spans[i, 0]], ends[first[i]:last[i]], [spans[i, 1]]]), *spans[i])
            own[i] = first[i] + int(np.argmax(np.diff(bounds)))
    else:
        own = first
    return np.bincount(np.minimum(own, len(ends) - 1), minlength=len(ends)) if len(ends) else np.zeros(0, np.int64), crossing


def count_tokens(docs: DataFrame, path: str | None = None, rule: str = "start", cut=line_ends) -> DataFrame:
    """``doc_id, n_tokens, n_sections, n_crossing, section_tokens`` per row of ``docs(doc_id, text)``."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    pattern = public_tokenizers.PATTERN

    def run(batches):
        coder = encoder(path, regex.compile(pattern).findall, spans=True)
        for batch in batches:
            found = []
            for text in batch.column(1):
                text = text.as_py() or ""
                spans = coder.spans(text) if text else np.zeros((0, 2), np.int64)
                sections, crossing = attribute(spans, cut(text) if text else np.zeros(0, np.int64), rule)
                found.append((len(spans), len(sections), crossing, sections.tolist()))
            total, n, crossing, sections = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(n, pa.int32()), pa.array(crossing, pa.int32()),
                 pa.array(sections, pa.list_(pa.int64()))], ["doc_id", "n_tokens", "n_sections", "n_crossing", "section_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_sections int, n_crossing int, section_tokens array<long>")


def query(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
