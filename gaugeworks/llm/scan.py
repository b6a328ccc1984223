"""Lines and words of a batch of whole texts, as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are looked at together.
SLICE_BYTES = 2 << 20

BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def byte_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes of text at a time; a longer text is one alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        past = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, past + most, side="right")))
        yield start, stop
        start = stop


class TextScan:
    """Positions in the joined UTF-8 bytes of texts; a null is like an empty text.

    Lines are parted at \\n (an empty text is one empty line), words at runs of
    \\x20 and \\x09-\\x0D. Equal words of the batch have equal ids, so do equal lines.
    """

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "")
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        self.docs = len(texts)
        self.doc_start = np.concatenate(([0], np.cumsum(lengths)))
        self.data = np.frombuffer(b"".join(v.as_buffer() for v in texts), dtype=np.uint8)
        size = len(self.data)

        blank = BLANK[self.data]
        begins = ~blank
        begins[1:] &= blank[:-1] | self._at_doc_start(size)[1:]
        self.word_start = np.flatnonzero(begins)
        self.word_doc = np.searchsorted(self.doc_start, self.word_start, side="right") - 1
        words = pc.ascii_split_whitespace(texts).flatten()
        words = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
        self.word_id = words.indices.to_numpy().astype(np.int64)
        self.words = words.dictionary

        breaks = np.flatnonzero(self.data == 10)
        lines = pc.split_pattern(texts, "\n")
        per_doc = np.diff(lines.offsets.to_numpy()).astype(np.int64)
        self.line_doc = np.repeat(np.arange(self.docs), per_doc)
        self.doc_line = np.concatenate(([0], np.cumsum(per_doc)))
        self.line_id = lines.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
        starts = np.empty(len(self.line_doc), dtype=np.int64)
        first = np.zeros(len(starts), dtype=bool)
        first[self.doc_line[:-1]] = True
        starts[first] = self.doc_start[:-1]
        starts[~first] = breaks + 1
        self.line_start = starts
        last = np.zeros(len(starts), dtype=bool)
        last[self.doc_line[1:] - 1] = True
        ends = np.empty(len(starts), dtype=np.int64)
        ends[last] = self.doc_start[1:]
        ends[~last] = breaks
        self.line_end = ends
        before_doc = np.concatenate(([0], np.cumsum(np.bincount(self.word_doc, minlength=self.docs))))
        self.doc_word = before_doc
        self.line_word = np.searchsorted(self.word_start, self.line_start, side="left")
        self.line_word_end = np.searchsorted(self.word_start, self.line_end, side="left")

    def _at_doc_start(self, size: int) -> np.ndarray:
        at = np.zeros(size, dtype=bool)
        at[self.doc_start[:-1][self.doc_start[:-1] < size]] = True
        return at

    def count(self, marked: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many marked bytes lie in each range."""
        sums = np.concatenate(([0], np.cumsum(marked)))
        return sums[end] - sums[start]

    def per_doc(self, marked: np.ndarray) -> np.ndarray:
        return self.count(marked, self.doc_start[:-1], self.doc_start[1:])
