"""Token ids of whole texts by the tokenizers library, one call per distinct piece of text.

A text is cut where a white-space run follows a character that is surely no white space.
Neither a normalizer nor a split pattern looks across such a place, so the ids of a text are
the ids of its pieces one after another. The distinct pieces of a block go to the library; the
texts are then put together from their pieces' ids in numpy.

For a tokenizer that lower-cases, drops white space and splits letters from punctuation (its
own description says so) A-Z are lowered, pieces lose their leading white space, and another
cut is made where punctuation follows a letter, so there are fewer distinct pieces. A piece of
nothing but small Latin-1 letters is what its normalizer and its split would leave: such
pieces go to the same model without those two steps.
"""

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from pulsetide.llm.common import blocks, ragged, text_buffers

#: Distinct pieces a worker remembers, the longest piece worth remembering, and the bytes of
#: text it works on at once.
REMEMBERED, LONGEST, AT_ONCE = 1 << 21, 64, 6 << 20
#: Pieces in one call of the library.
CALLED = 1 << 9
#: The one split pattern known to hold no white space and to part letters from punctuation.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Punctuation that gets a piece of its own after a letter.
MARKS = '!"#$%&()*+,-./:;=?@[\\]^_`{}~'
_MARKS = np.isin(np.arange(256), list(MARKS.encode()))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

# A task has one core; the library must not start threads of its own.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_loaded: dict[str, "Pieces"] = {}


class Pieces:
    """A tokenizer with the ids of the pieces it has seen."""

    def __init__(self, described: str):
        self.tokenizer = Tokenizer.from_str(described)
        self.words_only = drops_space_and_case(described)
        self.model_only = without_first_steps(described) if self.words_only else None
        self._forget()

    @classmethod
    def of(cls, described: str) -> "Pieces":
        """The worker's one instance for a tokenizer's JSON."""
        if described not in _loaded:
            _loaded.clear()
            _loaded[described] = cls(described)
        return _loaded[described]

    def _forget(self) -> None:
        # Remembered pieces in the order of their hashes, and where each one's ids lie.
        self.hashes = np.zeros(0, np.uint64)
        self.which = np.zeros(0, np.int64)
        self.known = pa.array([], pa.large_string())
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin (one more than texts)."""
        raw, offsets = text_buffers(texts)
        parts, ends = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        total = 0
        for first, last in blocks(offsets, AT_ONCE):
            low, high = offsets[first], offsets[last]
            ids, bounds = self._block(raw[low:high], offsets[first : last + 1] - low)
            parts.append(ids)
            ends.append(bounds[1:] + total)
            total += len(ids)
        return np.concatenate(parts), np.concatenate(ends)

    def _block(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.words_only:
            raw = lowered(raw)
        cuts = piece_starts(raw, offsets, self.words_only)
        edges = np.append(cuts, len(raw)).astype(np.int64)
        if self.words_only:
            raw, edges = without_leading_space(raw, edges)
        pieces = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(edges), pa.py_buffer(raw))
        coded = pieces.dictionary_encode()
        firsts, sizes, ids = self._ids_of(coded.dictionary)
        codes = coded.indices.to_numpy()
        per_piece = sizes[codes]
        before = np.concatenate([[0], np.cumsum(per_piece)])
        return ids[ragged(firsts[codes], per_piece)], before[np.searchsorted(cuts, offsets)]

    def _ids_of(self, distinct: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place and number of the ids of every piece, in the array of ids given last."""
        hashes = hashed(distinct)
        where = np.searchsorted(self.hashes, hashes)
        found = where < len(self.hashes)
        found[found] = self.hashes[where[found]] == hashes[found]
        places = np.full(len(distinct), -1, np.int64)
        places[found] = self.which[where[found]]
        # Equal hashes only point at a piece; its text decides.
        same = pc.equal(self.known.take(pa.array(places, mask=~found)), distinct).fill_null(False)
        found = same.to_numpy(zero_copy_only=False)
        firsts, sizes = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        firsts[found] = self.starts[places[found]]
        sizes[found] = self.starts[places[found] + 1] - firsts[found]
        if found.all():
            return firsts, sizes, self.ids
        unknown = distinct.filter(pa.array(~found))
        new_ids, new_sizes = self._encoded(unknown)
        firsts[~found] = len(self.ids) + np.cumsum(new_sizes) - new_sizes
        sizes[~found] = new_sizes
        ids = np.concatenate([self.ids, new_ids])
        self._remember(unknown, hashes[~found], new_ids, new_sizes)
        return firsts, sizes, ids

    def _encoded(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, and how many each has."""
        if not self.words_only:
            return called(self.tokenizer, pieces)
        plain = small_letters(pieces)
        parts, sizes = [], np.zeros(len(pieces), np.int64)
        for chosen, tokenizer in ((plain, self.model_only), (~plain, self.tokenizer)):
            ids, sizes[chosen] = called(tokenizer, pieces.filter(pa.array(chosen)))
            parts.append(ids)
        order = np.argsort(~plain, kind="stable")
        begins = np.zeros(len(pieces), np.int64)
        begins[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate(parts)[ragged(begins, sizes)], sizes

    def _remember(self, pieces: pa.LargeStringArray, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Keep the ids of short pieces; of pieces with one hash only the first is kept."""
        short = pc.less_equal(pc.binary_length(pieces), LONGEST).to_numpy(zero_copy_only=False)
        at = np.searchsorted(self.hashes, hashes)
        taken = at < len(self.hashes)
        taken[taken] = self.hashes[at[taken]] == hashes[taken]
        short &= ~taken
        if len(self.which) + short.sum() > REMEMBERED:
            self._forget()
        chosen = np.flatnonzero(short)
        chosen = chosen[np.argsort(hashes[chosen], kind="stable")]
        chosen = chosen[np.append(True, hashes[chosen[1:]] != hashes[chosen[:-1]])[: len(chosen)]]
        hashes = hashes[chosen]
        begins = np.cumsum(sizes) - sizes
        at = np.searchsorted(self.hashes, hashes)
        self.which = np.insert(self.which, at, np.arange(len(chosen)) + len(self.known))
        self.hashes = np.insert(self.hashes, at, hashes)
        self.known = pa.concat_arrays([self.known, pieces.take(pa.array(chosen))])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes[chosen])])
        self.ids = np.concatenate([self.ids, ids[ragged(begins[chosen], sizes[chosen])]])


def called(tokenizer: Tokenizer, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces by the library, each split and merged alone, and how many each has."""
    ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for first in range(0, len(pieces), CALLED):
        words = pieces.slice(first, CALLED).to_pylist()
        (together,) = tokenizer.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)
        of = together.word_ids
        if None in of:  # a special token, which belongs to no word
            each = [x.ids for x in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            ids.append(np.array([i for x in each for i in x], np.uint32))
            sizes.append(np.array([len(x) for x in each], np.int64))
        else:
            ids.append(np.array(together.ids, np.uint32))
            sizes.append(np.bincount(np.array(of, np.int64), minlength=len(words)))
    return np.concatenate(ids), np.concatenate(sizes)


def drops_space_and_case(described: str) -> bool:
    """Whether the tokenizer lower-cases, and splits by the pattern ``WORDS``.

    True only for the parts named here; any other tokenizer gets its pieces as they are.
    """
    whole = json.loads(described)
    normalizer, splitter = whole.get("normalizer") or {}, whole.get("pre_tokenizer") or {}
    normalizers = normalizer.get("normalizers", [normalizer])
    first = splitter.get("pretokenizers", [splitter])[0]
    spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    words = {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True}
    lowers = {"type": "Lowercase"}
    steps = lowers in normalizers and all(x in ({"type": "NFC"}, spaces, lowers) for x in normalizers)
    added = "".join(x["content"] for x in whole.get("added_tokens") or [])
    # A special token must not be cut or lowered.
    untouched = added == added.lower() and not set(added) & {*MARKS, *" \t\n\v\f\r"}
    return first == words and steps and untouched


def without_first_steps(described: str) -> Tokenizer:
    """The tokenizer without its normalizer and its split."""
    whole = json.loads(described)
    whole["normalizer"] = None
    whole["pre_tokenizer"]["pretokenizers"] = whole["pre_tokenizer"]["pretokenizers"][1:]
    return Tokenizer.from_str(json.dumps(whole))


def small_letters(pieces: pa.LargeStringArray) -> np.ndarray:
    """Whether a piece holds nothing but a-z and small letters of the Latin-1 block."""
    raw, offsets = text_buffers(pieces)
    good = (raw >= 97) & (raw <= 122)
    latin = np.zeros(len(raw), bool)
    latin[1:] = (raw[:-1] == 0xC3) & (((raw[1:] >= 0xA0) & (raw[1:] <= 0xBF) & (raw[1:] != 0xB7)) | (raw[1:] == 0x9F))
    good |= latin
    good[:-1] |= latin[1:]
    before = np.concatenate([[0], np.cumsum(good)])
    return before[offsets[1:]] - before[offsets[:-1]] == np.diff(offsets)


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z and the capitals of the Latin-1 block as small letters.

    Not where the next character may be a combining mark (none is below U+0300): composition
    with a mark may differ between a letter and its small form.
    """
    capital = (raw >= 65) & (raw <= 90)
    capital[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
    capital[:-1] &= raw[1:] < 0xC4
    return raw + (capital.view(np.uint8) << 5)


def without_leading_space(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces without the ASCII white space they begin with; edges: one more than pieces."""
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    solid = np.append(np.flatnonzero(~space), len(raw))
    begins = np.minimum(solid[np.searchsorted(solid, edges[:-1])], edges[1:])
    kept = edges[1:] - begins
    return raw[ragged(begins, kept)], np.concatenate([[0], np.cumsum(kept)])


def hashed(pieces: pa.LargeStringArray) -> np.ndarray:
    """A 64-bit polynomial hash of every piece."""
    raw, offsets = text_buffers(pieces)
    sizes = np.diff(offsets)
    total = np.zeros(len(sizes), np.uint64)
    if not len(raw):
        return total
    longest = int(sizes.max())
    powers = np.cumprod(np.full(longest + 1, _FACTOR, np.uint64), dtype=np.uint64)
    back = np.repeat(offsets[1:], sizes) - np.arange(len(raw))  # from 1, at a piece's last byte
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[back], dtype=np.uint64)])
    total = sums[offsets[1:]] - sums[offsets[:-1]]
    total ^= total >> np.uint64(31)
    return total * _FACTOR


def piece_starts(raw: np.ndarray, offsets: np.ndarray, punctuation: bool = False) -> np.ndarray:
    """First bytes of the pieces; every text that is not empty starts one.

    A piece starts at an ASCII white space after a printable ASCII character or a letter of
    the Latin-1 block (two bytes, the first of them 0xC3); with ``punctuation``, also at one of
    ``MARKS`` after a letter a-z or a small letter of that block.
    """
    if not len(raw):
        return np.zeros(0, np.int64)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    latin = np.zeros(len(raw), bool)
    latin[1:] = raw[:-1] == 0xC3
    solid = ((raw > 32) & (raw < 127)) | latin
    cut = np.zeros(len(raw), bool)
    cut[1:] = space[1:] & solid[:-1]
    if punctuation:
        letter = ((raw >= 97) & (raw <= 122)) | (latin & (raw >= 0x9F) & (raw != 0xB7))
        cut[1:] |= _MARKS[raw[1:]] & letter[:-1]
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(cut)
