"""Token ids of whole texts with the ``tokenizers`` library.

Byte-level BPE splits a text into pieces before merging, and a single space
between two non-space characters always starts a piece.  Texts are therefore
cut there and every distinct chunk of a slice of texts is looked up once, in a
bounded cache that keeps the ids of chunks between slices; the ids are those of
encoding the whole text, special-token strings included.  Runs of white space
stay inside one chunk.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 2_000_000  # characters handled at once
KEEP = 400_000     # chunks in each of the cache's two halves, about 250 MB in all
# the last three are white space to some Unicode versions only
BLANK = r"\s\u180e\u200b\ufeff"
CUT = re.compile(rf"(?<=[^{BLANK}]) (?=[^{BLANK}])")


def blank(c: str) -> bool:
    return c.isspace() or c in "\u180e\u200b\ufeff"


class ChunkEncoder:
    """Encodes texts to little-endian id bytes of ``dtype`` (16 bits when the
    vocabulary allows, else 32)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives one core to a task
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        size = self.tok.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 65536 else "<u4")
        self.opens = np.zeros(size, bool)  # ids whose text starts with a space
        for piece, i in self.tok.get_vocab().items():
            self.opens[i] = piece.startswith("Ġ")
        self.known: dict[str, bytes] = {}  # chunks used since the last turn
        self.older: dict[str, bytes] = {}  # and in the one before; the rest is dropped

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[str]) -> None:
        """Ids of ``" " + chunk`` for chunks without spaces, 512 in one text."""
        width = self.dtype.itemsize
        groups = [chunks[i:i + 512] for i in range(0, len(chunks), 512)]
        for group, enc in zip(groups, self.tok.encode_batch_fast(
                [" " + " ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(enc.ids, self.dtype)
            at = (np.flatnonzero(self.opens[ids]) * width).tolist()
            raw = ids.tobytes()
            for chunk, a, z in zip(group, at, at[1:] + [len(raw)], strict=True):
                self.known[chunk] = raw[a:z]

    def _chunk_ids(self, chunks: list[str]) -> tuple[list[bytes], np.ndarray]:
        """Ids of each of the distinct ``chunks`` after a space, and which ones
        are empty or begin or end with white space (their ids are empty)."""
        if len(self.known) > KEEP:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        odd = np.zeros(len(chunks), bool)
        found: list[bytes] = []
        fresh: list[int] = []
        for i, chunk in enumerate(chunks):
            ids = known.get(chunk)
            if ids is None:
                ids = older.get(chunk)
                if ids is not None:
                    known[chunk] = ids
                elif not chunk or blank(chunk[0]) or blank(chunk[-1]):
                    odd[i], ids = True, b""
                else:
                    fresh.append(i)
            found.append(ids)
        self._learn([chunks[i] for i in fresh])
        for i in fresh:
            found[i] = known[chunks[i]]
        return found, odd

    def _slice(self, texts: list[tuple[str, bool]]) -> list[bytes]:
        """``texts``: (text, whether a space precedes it)."""
        split = pc.split_pattern(pa.array([t for t, _ in texts], pa.large_string()), " ")
        ends = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        chunks = coded.dictionary.to_pylist()
        raw, odd = self._chunk_ids(chunks)
        slow = np.logical_or.reduceat(odd[at], ends[:-1])
        # a text's first chunk has no space before it: entries of their own
        first = [i for i, (_, led) in enumerate(texts) if not led and not slow[i]]
        opening = at[ends[first]]
        at[ends[first]] = len(raw) + np.arange(len(first))
        raw += self._plain([chunks[i] for i in opening])
        # the ids of all chunks in their places, one after the other
        placed = pa.array(raw, pa.large_binary()).take(pa.array(at))
        bounds = np.frombuffer(placed.buffers()[1], np.int64)[ends].tolist()
        ids = memoryview(placed.buffers()[2] or b"")
        out = [bytes(ids[a:z]) for a, z in zip(bounds, bounds[1:])]
        for i in np.flatnonzero(slow).tolist():
            text, led = texts[i]
            head, *rest = CUT.split(text)
            out[i] = b"".join(self._plain([" " + head if led else head, *(" " + c for c in rest)]))
        return out

    def encode(self, texts: list) -> list[bytes]:
        """Id bytes of each text; null is empty."""
        out: list[list[bytes]] = [[] for _ in texts]
        part: list[tuple[str, bool]] = []
        owner: list[int] = []
        held = 0

        def flush():
            for i, raw in zip(owner, self._slice(part)):
                out[i].append(raw)

        for i, text in enumerate(texts):
            at, led = 0, False
            while text and at < len(text):
                cut = CUT.search(text, at + SLICE) if len(text) - at > SLICE else None
                end = cut.start() if cut else len(text)
                part.append((text[at:end], led))
                owner.append(i)
                held += end - at
                at, led = end + 1, True
                if held >= SLICE:
                    flush()
                    part, owner, held = [], [], 0
        if part:
            flush()
        return [p[0] if len(p) == 1 else b"".join(p) for p in out]


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
