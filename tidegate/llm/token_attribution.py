"""Token counts by field and section, from one encoding of the whole document.

The fields of a document, one after another with a separator, are encoded once, so
tokens are those that training would see. Each field is cut into sections, its
lines. Spans of tokens and of sections are joined as intervals: each token goes to
sections by an explicit rule.

- Sections tile the document: a line owns its line end, a field's last line the
  separator behind it. So no token is lost between sections.
- ``"start"``: a token belongs to the section in which its first byte lies.
- ``"most"``: to the section that holds most of its bytes; of equals the first.

Under either rule counts of a document's sections add up to its tokens. A token of
part of a character (byte-level vocabularies have such) starts at its own first byte.
Both are rows of one document, so the join is a sorted search within the row; nothing
is shuffled.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from tidegate.llm.frames import fields

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How that vocabulary's texts are cut before merging; fixed with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEPARATOR = "\n\n"
RULES = ("start", "most")
#: Rows of the result that a task hands over at a time.
OUT_ROWS = 50_000

_encoders: dict[int, tuple[tiktoken.Encoding, np.ndarray]] = {}


def encoder(ranks: bytes, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The tokenizer and its tokens' lengths in bytes; made once in a worker."""
    key = hash((ranks, pattern))
    if key not in _encoders:
        table = {
            base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())
        }
        lengths = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            lengths[rank] = len(token)
        made = tiktoken.Encoding("tokens", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        _encoders[key] = (made, lengths)
    return _encoders[key]


def sections(texts: list[str]) -> tuple[str, list[tuple[int, int, int, int]]]:
    """The whole document and its sections: (field, number within it, start, end) in characters."""
    spans, at = [], 0
    for field, text in enumerate(texts):
        lines = text.split("\n")
        for number, line in enumerate(lines):
            last = number == len(lines) - 1
            tail = (len(SEPARATOR) if field < len(texts) - 1 else 0) if last else 1
            spans.append((field, number, at, at + len(line) + tail))
            at += len(line) + tail
    return SEPARATOR.join(texts), spans


def allocate(token_ends: np.ndarray, section_starts: np.ndarray, size: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and of them those that reach beyond it; all in bytes."""
    starts = np.concatenate([[0], token_ends[:-1]]) if len(token_ends) else token_ends
    ends = np.append(section_starts[1:], size)
    # Of empty sections at one place the last owns what starts there: it is the one with room.
    owner = np.searchsorted(section_starts, starts, side="right") - 1
    if rule == "most":
        for i in np.flatnonzero(token_ends > ends[owner]):
            best, held = owner[i], ends[owner[i]] - starts[i]
            for s in range(owner[i] + 1, len(ends)):
                if section_starts[s] >= token_ends[i]:
                    break
                within = min(ends[s], token_ends[i]) - section_starts[s]
                if within > held:
                    best, held = s, within
            owner[i] = best
    crossing = (token_ends > ends[owner]) | (starts < section_starts[owner])
    n = len(section_starts)
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def attribute(
    docs: DataFrame,
    columns: list[str],
    rule: str = "start",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
) -> DataFrame:
    """A row per document and section: doc_id, field, section, char_start, char_end, n_tokens, n_crossing.

    ``columns`` are the fields in order; a null one is empty, and an empty one is a
    section without characters, so every document has rows. ``char_start`` and
    ``char_end`` are places in the joined document. ``n_crossing`` counts those of
    the section's tokens that lie partly in another. Repeated rows and null ids are
    handled row by row. Columns not named are ignored; an empty table gives no rows.
    The vocabulary is read on the driver and broadcast: a file of fixed size.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    with open(vocabulary, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    chosen = fields(docs, "doc_id", *columns)
    kind = chosen.schema["doc_id"].dataType.simpleString()
    names = ["field", "section", "char_start", "char_end", "n_tokens", "n_crossing"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, lengths = encoder(shared.value, pattern)
        for batch in batches:
            texts = zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True)
            rows, blocks = [], []

            def out() -> pa.RecordBatch:
                table = np.concatenate(blocks)
                at = pa.array(np.repeat(np.array(rows), [len(b) for b in blocks]))
                columns_ = [pa.array(c) for c in table[:, 1:].T]
                field = pa.array(columns)  # names by position
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), field.take(pa.array(table[:, 0])), *columns_],
                    names=["doc_id", *names],
                )

            held = 0
            for i, parts in enumerate(texts):
                whole, spans = sections([p or "" for p in parts])
                table = np.array(spans, np.int64)
                data = whole.encode()
                ends = np.cumsum(lengths[np.array(made.encode_ordinary(whole), np.int64)])
                starts = table[:, 2]
                if len(data) != len(whole):  # characters to bytes
                    first = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
                    starts = np.append(first, len(data))[starts]
                counts = allocate(ends, starts, len(data), rule)
                rows.append(i)
                blocks.append(np.column_stack([table, *counts]))
                held += len(table)
                if held >= OUT_ROWS:
                    yield out()
                    rows, blocks, held = [], [], 0
            if blocks:
                yield out()

    return chosen.mapInArrow(
        of, f"doc_id {kind}, field string, " + ", ".join(f"{n} bigint" for n in names[1:])
    )
