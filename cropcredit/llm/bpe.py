"""Token ids of whole texts by a public tokenizer file, each distinct piece encoded once.

White space is never inside a token that other characters begin: with the word-splitting rules
of the tokenizer files used here, a token never reaches from a character that is no white space
into white space that follows it. So a text can be cut before each ASCII white space that
follows something else, the pieces encoded alone, and their ids joined give the ids of the whole
text. (Cuts after characters that could be Unicode white space are left out.) Each distinct
piece goes through the tokenizers library once per Python worker.

With ``specials`` a special token of the file that stands in a text (``<|endoftext|>``) becomes its
one id, as in the library's plain call; without, it is encoded as text. Special tokens of these
files hold no white space and take none beside them, so the cuts hold either way.

New pieces go through the library ``JOINED`` at a time, as one text with a special token of the file
after each: the library cuts a text at its special tokens before anything else, so each piece is encoded
as if it stood alone, and that token's id tells their ids apart. Pieces that hold a special token
themselves, and files without a fit one, are encoded one by one.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from cropcredit.llm.bytes_np import as_strings, blocks, buffers, run_hashes

#: Distinct pieces kept per Python worker; beyond it the memory is started anew.
KEEP_PIECES = 2_000_000
#: New pieces that are encoded as one text.
JOINED = 64

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def piece_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Starts of the pieces: text starts and cuts before white space after something else."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n:
        space = _SPACE[data]
        cut[1:n] = space[1:] & ~space[:-1] & (data[:-1] >= 33)
        far = np.flatnonzero(cut[:n] & np.concatenate([[False], data[:-1] >= 0x80]))
        # the character before ends in a non-ASCII byte: keep the cut unless its lead byte is one
        # of Unicode white space (C2 85, C2 A0, E1 9A 80, E2 80 xx, E2 81 9F, E3 80 80)
        if len(far):
            two = data[np.maximum(far - 2, 0)] == 0xC2
            three = np.isin(data[np.maximum(far - 3, 0)], (0xE1, 0xE2, 0xE3))
            cut[far[two | three]] = False
        cut[np.concatenate([[False], (data[:-1] >= 28) & (data[:-1] <= 31)]).nonzero()[0]] = False
    cut[offs[:-1]] = True
    cut[n] = False
    return np.flatnonzero(cut)


class Encoder:
    """Ids of whole texts; ``path`` is a file of the tokenizers library. Known pieces are kept by
    64-bit hash in sorted arrays (about 50 bytes a piece), over all tasks of a Python worker. Their bytes are kept too:
    a block's bytes are put together from its known pieces and compared, so that pieces of one hash can't take
    each other's ids (a block where they differ is encoded text by text)."""

    def __init__(self, path: str, specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.specials = specials
        self.tok.encode_special_tokens = not specials
        added = self.tok.get_added_tokens_decoder()
        self.marks = [t.content for t in added.values()]
        # fit: takes nothing beside it and can't begin within itself
        fit = [i for i, t in added.items() if not (t.normalized or t.lstrip or t.rstrip or t.single_word)
               and not any(t.content.endswith(t.content[:k]) for k in range(1, len(t.content)))]
        self.mark_id = fit[0] if fit and all(t.special for t in added.values()) else None
        self.mark = added[fit[0]].content if self.mark_id is not None else None
        self.seed = int.from_bytes(os.urandom(7), "little")
        self.kind = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self._clear()

    def _clear(self):
        self.key = np.zeros(0, np.uint64)  # sorted hashes of the known pieces
        self.at = np.zeros(0, np.int64)  # piece k: flat[at[k]:at[k] + size[k]]
        self.size = np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, self.kind), 0
        self.raw_at = np.zeros(0, np.int64)  # and its bytes: raw[raw_at[k]:raw_at[k] + raw_size[k]]
        self.raw_size = np.zeros(0, np.int64)
        self.raw, self.raw_used = np.zeros(1 << 16, np.uint8), 0

    def _one_by_one(self, pieces: list[str]):
        """(ids of all pieces joined, number of ids of each)."""
        got = [e.ids for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]
        n = np.fromiter(map(len, got), np.int32, len(got))
        return np.fromiter(chain.from_iterable(got), self.kind, int(n.sum())), n

    def _ids(self, raw: list[bytes]):
        """(ids of all pieces joined, number of ids of each)."""
        if self.mark is None:
            return self._one_by_one([r.decode() for r in raw])
        end = self.mark.encode()
        groups = [raw[k: k + JOINED] for k in range(0, len(raw), JOINED)]
        texts = [end.join([*g, b""]).decode() for g in groups]
        held = [sum(map(t.count, self.marks)) for t in texts]  # more than the pieces: one stands in a piece
        self.tok.encode_special_tokens = False
        whole = iter(self.tok.encode_batch_fast([t for t, h, g in zip(texts, held, groups) if h == len(g)], add_special_tokens=False))
        self.tok.encode_special_tokens = not self.specials
        out = []
        for g, h in zip(groups, held):
            ids = np.array(next(whole).ids, self.kind) if h == len(g) else np.zeros(0, self.kind)
            ends = np.flatnonzero(ids == self.mark_id)
            out.append((np.delete(ids, ends), np.diff(ends, prepend=-1).astype(np.int32) - 1) if len(ends) == len(g)
                       else self._one_by_one([r.decode() for r in g]))
        return np.concatenate([ids for ids, _ in out]), np.concatenate([n for _, n in out])

    def _learn(self, keys: np.ndarray, raw: list[bytes]) -> None:
        raw_size = np.fromiter(map(len, raw), np.int64, len(raw))
        raw_at = self.raw_used + np.cumsum(raw_size) - raw_size
        while self.raw_used + int(raw_size.sum()) > len(self.raw):
            self.raw = np.concatenate([self.raw, np.zeros_like(self.raw)])
        self.raw[self.raw_used: self.raw_used + int(raw_size.sum())] = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_used += int(raw_size.sum())
        at, size = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int32)
        for lo in range(0, len(raw), 4096):
            ids, n = self._ids(raw[lo: lo + 4096])
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used: self.used + len(ids)] = ids
            size[lo: lo + len(n)] = n
            at[lo: lo + len(n)] = self.used + np.cumsum(n) - n
            self.used += len(ids)
        place = np.searchsorted(self.key, keys)
        self.key = np.insert(self.key, place, keys)
        self.at = np.insert(self.at, place, at)
        self.size = np.insert(self.size, place, size)
        self.raw_at = np.insert(self.raw_at, place, raw_at)
        self.raw_size = np.insert(self.raw_size, place, raw_size)

    def _same(self, data: np.ndarray, code: np.ndarray, size: np.ndarray) -> bool:
        """Whether the known pieces ``code``, joined, are ``data`` (the joined pieces of sizes ``size``)."""
        if not np.array_equal(self.raw_size[code], size):
            return False
        take = np.repeat(self.raw_at[code] - (np.cumsum(size) - size), size)
        take += np.arange(len(data))
        return np.array_equal(self.raw[take], data)

    def _plain(self, arr: pa.LargeStringArray):
        got = [e.ids for e in self.tok.encode_batch_fast(arr.to_pylist(), add_special_tokens=False)]
        offs = np.concatenate([[0], np.cumsum([len(g) for g in got])])
        return np.fromiter(chain.from_iterable(got), np.uint32, int(offs[-1])), offs

    def block(self, arr: pa.LargeStringArray):
        """(ids of all texts joined, offsets of each text's ids) for one block of texts."""
        data, offs = buffers(arr)
        starts = piece_starts(data, offs)
        starts = starts[starts < len(data)]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(arr) + 1, np.int64)
        ends = np.append(starts[1:], len(data))
        keys, first, code = np.unique(run_hashes(data, starts, ends, self.seed), return_index=True, return_inverse=True)
        if len(self.key) > KEEP_PIECES:
            self._clear()
        where = np.searchsorted(self.key, keys)
        new = np.ones(len(keys), bool)
        if len(self.key):
            new = self.key[np.minimum(where, len(self.key) - 1)] != keys
        if new.any():
            raw, f = data.tobytes(), first[new]
            self._learn(keys[new], [raw[a:b] for a, b in zip(starts[f].tolist(), ends[f].tolist())])
            where = np.searchsorted(self.key, keys)
        code = where[code]
        if not self._same(data, code, ends - starts):
            return self._plain(arr)
        sizes = self.size[code].astype(np.int64)
        done = np.concatenate([[0], np.cumsum(sizes)])
        take = np.repeat(self.at[code] - done[:-1], sizes) + np.arange(int(done[-1]))
        return self.flat[take].astype(np.uint32), done[np.searchsorted(starts, offs, "left")]

    def rows(self, col):
        """The ids of each text of an Arrow column, in order."""
        arr = as_strings(col)
        for lo, hi in blocks(arr):
            ids, offs = self.block(arr.slice(lo, hi - lo))
            for k in range(hi - lo):
                yield ids[offs[k]: offs[k + 1]]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, specials: bool = False) -> Encoder:
    """One encoder per file, ``specials`` and Python worker."""
    if (path, specials) not in _ENCODERS:
        _ENCODERS[path, specials] = Encoder(path, specials)
    return _ENCODERS[path, specials]
