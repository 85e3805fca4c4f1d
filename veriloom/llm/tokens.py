"""Token ids of whole texts with the tokenizers library, as little-endian unsigned 32-bit integers.

Byte-level BPE never merges across the place before a single space or newline that a visible character follows, so a text's
ids are the ids of its pieces in a row. Arrow splits a chunk of texts into pieces and names the different ones; a worker
keeps the ids of those that it has seen, in two generations of KEPT at most, and encodes the unseen ones in few calls. Nor
does it merge letters with the ASCII marks after them, so a word is kept and encoded once for all marks that end it.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Iterable, Iterator

KEPT = 500_000
#: Pieces that one call of the library gets at most.
CALL = 4_000
#: Bytes of text that are split at once at most (or one text); what a chunk holds is kept besides KEPT.
CHUNK = 8_000_000
#: Marks at a piece's end that are kept apart from its letters, at most.
MARKS = 3
#: For Arrow's RE2, whose \s is ASCII: Python's white space, or the end, after a space or newline.
_UNEVEN = r"[ \n](?:[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\z)"
_BREAK = re.compile(r" (?=\S)|(?=\n\S)")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        from tokenizers import Tokenizer

        self.np = np
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        #: Pieces without the space before them, but with a newline; a text's first piece, which has neither, is encoded on its own.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        #: Whether an id's token begins with the sign of a space or newline.
        self.opens = np.zeros(self.model.get_vocab_size(), dtype=bool)
        for token, i in self.model.get_vocab().items():
            self.opens[i] = token.startswith(("Ġ", "Ċ"))

    def _ids(self, text: str):
        return self.np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _keep(self, pieces: list[str], ids: list[bytes]) -> None:
        if len(self.young) > KEPT:
            self.old, self.young = self.young, {}
        self.young.update(zip(pieces, ids))

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces, by the library."""
        full = [x if x[0] == "\n" else " " + x for x in pieces]
        ids = self._ids("".join(full))
        cuts = self.np.flatnonzero(self.opens[ids])
        if len(cuts) != len(full):  # a space or newline inside a piece: one at a time
            return [self._ids(x).tobytes() for x in full]
        data, ends = ids.tobytes(), [*(4 * cuts[1:]).tolist(), 4 * len(ids)]
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _known(self, pieces: list[str]) -> list[bytes]:
        """The ids of different pieces."""
        found = list(map(self.young.get, pieces))
        again, plain, odd = [], [], []
        for k in [k for k, x in enumerate(found) if x is None]:
            piece = pieces[k]
            found[k] = self.old.get(piece)
            (again if found[k] is not None else odd if " " in piece or "\n" in piece[1:] else plain).append(k)
        self._keep([pieces[k] for k in again], [found[k] for k in again])
        for some, most in ((plain, CALL), (odd, 1)):
            for lo in range(0, len(some), most):
                part = [pieces[k] for k in some[lo : lo + most]]
                ids = self._encoded(part)
                self._keep(part, ids)
                for k, x in zip(some[lo : lo + most], ids):
                    found[k] = x
        return found

    def _composed(self, pieces):
        """The ids of an array of different pieces: those of their letters, then those of the marks that end them."""
        import pyarrow as pa
        import pyarrow.compute as pc

        base = pc.ascii_rtrim(pieces, string.punctuation)
        n = pc.subtract(pc.binary_length(pieces), pc.binary_length(base))
        n = pc.if_else(pc.and_(pc.less_equal(n, MARKS), pc.utf8_is_alpha(pc.ascii_ltrim(base, "\n"))), n, 0)
        whole, mark = pc.equal(n, 0), pa.scalar("", pieces.type)
        for k in range(1, MARKS + 1):
            mark = pc.if_else(pc.equal(n, k), pc.utf8_slice_codeunits(pieces, -k), mark)
        base, mark = pc.if_else(whole, pieces, base).dictionary_encode(), mark.dictionary_encode()
        bases = pa.array(self._known(base.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        marks = pa.array([self._ids(x).tobytes() for x in mark.dictionary.to_pylist()], pa.large_binary())
        return pc.binary_join_element_wise(bases.take(base.indices), marks.take(mark.indices), pa.scalar(b"", pa.large_binary()))

    def _chunk(self, texts) -> list[bytes]:
        """The ids of an array of texts without nulls."""
        import pyarrow as pa
        import pyarrow.compute as pc

        np = self.np
        uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
        order = np.argsort(np.argsort(uneven, kind="stable"))  # where each text's pieces come: those of uneven ones last
        lists = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(~uneven)), "\n", " \n"), " ")
        if uneven.any():
            others = [_BREAK.split(x) for x in texts.filter(pa.array(uneven)).to_pylist()]
            lists = pa.concat_arrays([lists, pa.array(others, lists.type)])
        bounds = lists.offsets.to_numpy()
        bounds, pieces = bounds - bounds[0], lists.flatten()
        coded, heads = pieces.dictionary_encode(), bounds[:-1]
        which = coded.indices.to_numpy().copy()
        inner = np.ones(len(which), dtype=bool)
        inner[heads] = False
        used = np.zeros(len(coded.dictionary), dtype=bool)
        used[which[inner]] = True  # a piece that is first of its text only is no piece of this kind
        which = (np.cumsum(used) - 1)[which]
        which[heads] = used.sum() + np.arange(len(heads))
        known = self._composed(coded.dictionary.filter(pa.array(used)))
        first = self.model.encode_batch_fast(pieces.take(pa.array(heads)).to_pylist(), add_special_tokens=False)
        first = pa.array([np.array(x.ids, dtype="<u4").tobytes() for x in first], pa.large_binary())
        laid = pa.concat_arrays([known, first]).take(pa.array(which))
        _, ends, data = laid.buffers()
        cuts = np.frombuffer(ends, dtype="i8")[bounds]
        data = memoryview(data or b"")
        return [bytes(data[a:b]) for a, b in zip(cuts[order].tolist(), cuts[order + 1].tolist())]

    def stream(self, texts) -> Iterator[bytes]:
        """The ids of each text of an Arrow array, in its order; null: none. Holds those of a chunk."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends, lo = self.np.cumsum(pc.binary_length(texts).to_numpy()), 0
        while lo < len(texts):
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(self.np.searchsorted(ends, before + CHUNK, "right")))
            yield from self._chunk(texts.slice(lo, hi - lo))
            lo = hi

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text; null: none."""
        import pyarrow as pa

        return list(self.stream(pa.array(list(texts), pa.large_string())))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
