"""Byte-level BPE over Arrow batches: speculate with greedy longest matches, verify
every adjacent pair, and merge exactly only the words that fail.

A batch of texts is cut into words by class changes, the words are made distinct by
Arrow's dictionary, and all distinct words are encoded together with numpy.  A sequence
of tokens is the BPE encoding of its bytes exactly when each token encodes itself and
each adjacent pair is the encoding of its own bytes, so checking pairs verifies a word.

Results equal the tokenizers library's with ``add_special_tokens=False`` and neither
truncation nor padding.  Null and empty texts have no tokens.  The strings of added
tokens in a text become those tokens, as the library does by default.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Words beyond this many bytes are merged in pieces, which are joined where that is proven right.
LONG_WORD = 256
#: Bytes of a piece, and tokens on either side of a border that are merged anew at first.
PIECE, BESIDE = 32, 4
#: Bytes of text that are encoded at once; a longer text is encoded alone.
CHUNK_BYTES = 3 << 20
#: Ids that are decoded at once; a longer sequence is decoded alone.
CHUNK_IDS = 1 << 20

_LETTER, _NUMBER, _SPACE, _OTHER, _UNKNOWN = range(1, 6)


class Unsupported(ValueError):
    """The vocabulary is of a kind that this encoder doesn't know."""


class KeyTable:
    """Non-negative 64-bit keys to non-negative ints: open addressing, looked up by arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, np.int64)
        self._values = np.full(1 << bits, -1, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self._keys[slot[left]] == -1]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self._keys[slot[put]], self._values[slot[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            taken = left[self._keys[slot[left]] != -1]
            slot[taken] = (slot[taken] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 where a key is missing."""
        slot = self._slot(keys)
        found = self._keys[slot]
        out = np.where(found == keys, self._values[slot], np.int32(-1))
        left = np.flatnonzero((found != keys) & (found != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & self._mask
            found = self._keys[slot[left]]
            hit = found == keys[left]
            out[left[hit]] = self._values[slot[left[hit]]]
            left = left[~hit & (found != -1)]
        return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all pieces [start, start + length), one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def byte_symbols() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteBpe:
    """The tables of one vocabulary file.  Inside, bytes are tokens 0 to 255 and the token
    of merge ``k`` is ``256 + k``, so that a smaller number is an earlier merge."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._require(spec)
        symbols, model = byte_symbols(), spec["model"]
        text = lambda token: bytes(symbols[c] for c in token)
        names = {text(token): number for token, number in model["vocab"].items() if token not in self._added(spec)}
        tokens = [bytes([b]) for b in range(256)]
        index = {t: k for k, t in enumerate(tokens)}
        left, right = list(range(256)), list(range(256))
        for merge in model["merges"]:
            a, b = (text(x) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            if a + b in index:
                raise Unsupported(f"two merges make the same token: {a + b!r}")
            left.append(index[a])
            right.append(index[b])
            index[a + b] = len(tokens)
            tokens.append(a + b)
        self.size = len(tokens)
        self._left, self._right = np.array(left, np.int32), np.array(right, np.int32)
        self._ids = np.array([names[t] for t in tokens], np.int32)
        self._length = np.array([len(t) for t in tokens], np.int64)
        pairs = (self._left.astype(np.int64) << 32 | self._right)[256:]
        self._pairs = KeyTable(pairs, np.arange(256, self.size, dtype=np.int32))
        self.added = {x["content"].encode(): int(x["id"]) for x in spec.get("added_tokens") or []}
        self._find_added = re.compile(b"|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True)) or b"(?!)")
        self._pre = Tokenizer.from_file(path).pre_tokenizer
        self._classes = np.full(0x110000, _UNKNOWN, np.uint8)
        self._ascii = np.array([self._class(c) for c in range(128)] + [_OTHER] * 128, np.uint8)
        self._build_trie(tokens)
        known = dict(zip(self._ids.tolist(), tokens, strict=True)) | {n: t for t, n in self.added.items()}
        top = max(known) + 1
        #: The first number past the vocabulary; it has no bytes.
        self.blank = top
        self.token_bytes = pa.array([known.get(k, b"") for k in range(top + 1)], pa.large_binary())

    @staticmethod
    def _added(spec: dict) -> set[str]:
        return {x["content"] for x in spec.get("added_tokens") or []}

    @staticmethod
    def _require(spec: dict) -> None:
        """Refuse what this encoder doesn't do, rather than count it wrongly."""
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = all(not (x["single_word"] or x["lstrip"] or x["rstrip"]) for x in spec.get("added_tokens") or [])
        if (
            model["type"] != "BPE"
            or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space")
            or not pre.get("use_regex", True)
            or spec.get("normalizer")
            or any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            or not plain
        ):
            raise Unsupported("not a plain byte-level BPE vocabulary")

    def _class(self, point: int) -> int:
        """How the library's own splitter treats a character."""
        if point == 0x20:
            return _SPACE
        parts = [end - start for _, (start, end) in self._pre.pre_tokenize_str(f"1{chr(point)}a")]
        if len(parts) == 2:
            return _NUMBER if parts[0] == 2 else _LETTER
        return _SPACE if len(self._pre.pre_tokenize_str(chr(point) * 2 + "a")) == 3 else _OTHER

    def _build_trie(self, tokens: list[bytes]) -> None:
        """Only tokens that encode themselves can be proposed."""
        merged = np.arange(256, self.size, dtype=np.int32)
        own = np.ones(self.size, bool)
        own[256:] = self._compatible(self._left[256:], self._right[256:], merged)
        for k in range(256, self.size):
            own[k] &= own[self._left[k]] and own[self._right[k]]
        edges: dict[int, int] = {}
        accept = [-1]
        for number, token in enumerate(tokens):
            if not own[number]:
                continue
            node = 0
            for byte in token:
                key = node << 8 | byte
                node = edges.get(key, 0)
                if not node:
                    edges[key] = node = len(accept)
                    accept.append(-1)
            accept[node] = number
        self._edges = KeyTable(np.fromiter(edges, np.int64, len(edges)), np.fromiter(edges.values(), np.int32, len(edges)))
        self._accept = np.array(accept, np.int32)

    def _compatible(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses the border of two neighbouring tokens.

        Undo the merges beside the border from the latest on.  A merge across it would
        have happened if it is earlier than whatever consumed one of its two sides; equal
        merges go from left to right, so one on the right must be strictly earlier.
        """
        x, y = left.astype(np.int64), right.astype(np.int64)
        until = np.full(len(x), self.size, np.int64) if limit is None else limit.astype(np.int64)
        good = np.ones(len(x), bool)
        left_over = np.arange(len(x))
        while len(left_over):
            a, b = x[left_over], y[left_over]
            across = self._pairs.get(a << 32 | b)
            crossed = (across >= 0) & (across < until[left_over])
            good[left_over[crossed]] = False
            going = ~crossed & (np.maximum(a, b) >= 256)
            left_over, a, b = left_over[going], a[going], b[going]
            undo = a > b
            until[left_over] = np.where(undo, a, b + 1)
            x[left_over] = np.where(undo, self._right[a], a)
            y[left_over] = np.where(undo, b, self._left[b])
        return good

    def _word_starts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where words begin.  ``bounds``: where texts (or added tokens) begin, and the end."""
        n = len(data)
        kind = self._ascii[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            first = data[lead].astype(np.int32)
            more = 1 + (first >= 0xE0) + (first >= 0xF0)
            point = first & np.array([0, 0x1F, 0x0F, 0x07])[more]
            for k in (1, 2, 3):
                has = more >= k
                point[has] = point[has] << 6 | (data[lead[has] + k] & 0x3F)
            new = np.unique(point[self._classes[point] == _UNKNOWN])
            self._classes[new] = [self._class(int(c)) for c in new]
            of = self._classes[point]
            kind[lead] = of
            for k in (1, 2, 3):
                has = more >= k
                kind[lead[has] + k] = of[has]
        forced = np.zeros(n + 1, bool)
        forced[bounds] = True
        start = forced.copy()
        start[1:n] |= kind[1:] != kind[:-1]
        # the last space of a run goes with the next word if it is a blank, else it stands alone
        after = np.flatnonzero(start[1:n] & ~forced[1:n] & (kind[:-1] == _SPACE)) + 1
        last = after - 1
        for _ in range(3):
            last = last - ((data[last] & 0xC0) == 0x80)
        start[last] = True
        start[after[data[last] == 0x20]] = False
        quote = np.flatnonzero((data == 0x27) & start[:n])
        if len(quote):
            padded = np.concatenate([data, np.zeros(3, np.uint8)])
            ends = np.concatenate([forced, np.ones(2, bool)])
            one, two = padded[quote + 1], padded[quote + 2]
            inside = ~ends[quote + 1]
            length = np.where(inside & np.isin(one, np.frombuffer(b"stmd", np.uint8)), 1, 0)
            for pair in (b"re", b"ve", b"ll"):
                length[inside & ~ends[quote + 2] & (one == pair[0]) & (two == pair[1])] = 2
            quote, length = quote[length > 0], length[length > 0]
            start[quote + 1] = False
            start[quote + 1 + length] = True
        return np.flatnonzero(start[:n])

    def _propose(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all words, step by step: token counts and flat tokens."""
        owners, proposed = [], []
        position, active = start.copy(), np.flatnonzero(start < end)
        while len(active):
            here, stop = position[active], end[active]
            best, best_end = np.zeros(len(active), np.int32), here + 1
            node, cursor, live = np.zeros(len(active), np.int64), here.copy(), np.arange(len(active))
            while len(live):
                child = self._edges.get(node[live] << 8 | data[cursor[live]])
                live, child = live[child >= 0], child[child >= 0]
                node[live] = child
                cursor[live] += 1
                token = self._accept[child]
                hit = live[token >= 0]
                best[hit], best_end[hit] = token[token >= 0], cursor[hit]
                live = live[cursor[live] < stop[live]]
            owners.append(active)
            proposed.append(best)
            position[active] = best_end
            active = active[best_end < stop]
        owner, token = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owners, proposed))
        order = np.argsort(owner, kind="stable")
        return np.bincount(owner, minlength=len(start)), token[order]

    def _merge(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of all words at once: in each round every word makes all its
        earliest merges (a merge never enables an earlier one)."""
        lengths = end - start
        token = data[ragged(start, lengths)].astype(np.int64)
        word = np.repeat(np.arange(len(start)), lengths)
        done_word, done_token = [], []
        while len(token):
            joined = np.full(len(token), self.size, np.int64)
            same = np.flatnonzero(word[1:] == word[:-1])
            found = self._pairs.get(token[same] << 32 | token[same + 1]).astype(np.int64)
            joined[same] = np.where(found < 0, self.size, found)
            begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(begins, len(word)))
            least = np.repeat(np.minimum.reduceat(joined, begins), sizes)
            going = least < self.size
            done_word.append(word[~going])
            done_token.append(token[~going])
            token, word, joined, least = token[going], word[going], joined[going], least[going]
            if not len(token):
                break
            at = joined == least
            where = np.flatnonzero(at)
            runs = np.concatenate([[True], np.diff(where) > 1])
            run_start = where[np.flatnonzero(runs)][np.cumsum(runs) - 1]
            where = where[(where - run_start) % 2 == 0]
            token[where] = least[where]
            keep = np.ones(len(token), bool)
            keep[where + 1] = False
            token, word = token[keep], word[keep]
        word = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
        token = np.concatenate(done_token) if done_token else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        return np.bincount(word, minlength=len(start)), token[order].astype(np.int32)

    def _merge_long(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of long words: short pieces at once, then neighbours joined level by
        level, so that work grows with the length alone."""
        cuts = [np.append(np.arange(a, b, PIECE), b) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        if not cuts:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        count, flat = self._merge(data, np.concatenate([c[:-1] for c in cuts]), np.concatenate([c[1:] for c in cuts]))
        pieces = iter(np.split(flat, np.cumsum(count)[:-1]))
        words = [[next(pieces) for _ in c[1:]] for c in cuts]
        borders = [c[1:-1].tolist() for c in cuts]
        while any(borders):
            pairs, places = [], []
            for word, between in zip(words, borders, strict=True):
                pairs += zip(word[0::2], word[1::2], strict=False)
                places += between[0::2]
            joined = iter(self._joined(data, pairs, places))
            words = [[next(joined) for _ in range(len(w) // 2)] + w[len(w) - len(w) % 2 :] for w in words]
            borders = [between[1::2] for between in borders]
        return np.array([len(w[0]) for w in words]), np.concatenate([w[0] for w in words])

    def _joined(self, data: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], places: list[int]) -> list[np.ndarray]:
        """The encoding of each pair of neighbouring encodings, which meet at a byte of ``data``.

        Where the two tokens at the border are not compatible, some tokens on either side are
        merged anew; that is right if what comes out is compatible with its neighbours.
        """
        out: list[np.ndarray] = [np.concatenate(pair) for pair in pairs]
        fits = self._compatible(np.array([a[-1] for a, _ in pairs]), np.array([b[0] for _, b in pairs]))
        left, reach = np.flatnonzero(~fits).tolist(), BESIDE
        while left:
            before = [pairs[k][0][-reach:] for k in left]
            behind = [pairs[k][1][:reach] for k in left]
            at = np.array([places[k] for k in left])
            begin = at - np.array([self._length[x].sum() for x in before])
            stop = at + np.array([self._length[x].sum() for x in behind])
            count, flat = self._merge(data, begin, stop)
            middle = np.split(flat, np.cumsum(count)[:-1])
            rests = [(pairs[k][0][:-reach], pairs[k][1][reach:]) for k in left]
            good = np.ones(len(left), bool)
            for side, edges in ((0, [(r[0][-1:], m[:1]) for r, m in zip(rests, middle, strict=True)]), (1, [(m[-1:], r[1][:1]) for r, m in zip(rests, middle, strict=True)])):
                has = np.array([len(r[side]) > 0 for r in rests])
                if has.any():
                    x, y = (np.concatenate([e[n] for e, h in zip(edges, has, strict=True) if h]) for n in (0, 1))
                    good[has] &= self._compatible(x, y)
            for k, (first, last), m, ok in zip(left, rests, middle, good, strict=True):
                if ok:
                    out[k] = np.concatenate([first, m, last])
            left, reach = [k for k, ok in zip(left, good, strict=True) if not ok], 4 * reach
        return out

    def _encode_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and flat vocabulary ids of distinct words."""
        start, end = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
        words = len(start)
        short = np.flatnonzero(end - start <= LONG_WORD)
        count, flat = self._propose(data, start[short], end[short])
        owner = np.repeat(np.arange(len(short)), count)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        bad = np.zeros(len(short), bool)
        bad[owner[inner[~self._compatible(flat[inner], flat[inner + 1])]]] = True
        long = np.setdiff1d(np.arange(words), short, assume_unique=True)
        again = np.concatenate([short[bad], long])
        some = [self._merge(data, start[short[bad]], end[short[bad]]), self._merge_long(data, start[long], end[long])]
        exact_count, exact = (np.concatenate(x) for x in zip(*some, strict=True))
        counts = np.zeros(words, np.int64)
        counts[short] = count
        counts[again] = exact_count
        first = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        good = ~bad
        out[ragged(first[short[good]], count[good])] = self._ids[flat[good[owner]]]
        out[ragged(first[again], exact_count)] = self._ids[exact]
        return counts, out

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For texts in one buffer: the first word of each text (and the end), each word's
        number among the distinct words, and token counts and flat ids of those."""
        low, high = int(offsets[0]), int(offsets[-1])
        data, offsets = data[low:high], offsets - low
        raw = memoryview(data)
        bounds, marks = [offsets], []
        for found in self._find_added.finditer(raw):
            marks.append(found.span())
        if marks:
            spans = np.array(marks, np.int64)
            text = np.searchsorted(offsets, spans, side="right")
            spans = spans[(text[:, 0] == np.searchsorted(offsets, spans[:, 1], side="left"))]
            bounds.append(spans.ravel())
        starts = self._word_starts(data, np.concatenate(bounds))
        if marks and len(spans):
            inside = np.zeros(len(data) + 1, np.int8)
            inside[spans[:, 0] + 1] += 1
            inside[spans[:, 1]] -= 1
            starts = starts[np.cumsum(inside)[starts] == 0]
        edges = np.append(starts, len(data)).astype(np.int32)
        array = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data)])
        coded = array.dictionary_encode()
        distinct = coded.dictionary
        size = len(distinct)
        buffers = distinct.buffers()
        word_offsets = np.frombuffer(buffers[1], np.int32, size + 1, distinct.offset * 4)
        word_data = np.frombuffer(buffers[2] if buffers[2] is not None else b"", np.uint8)
        counts, ids = self._encode_words(word_data, word_offsets)
        for content, number in self.added.items() if marks else ():
            k = pa.compute.index(distinct, pa.scalar(content, pa.binary())).as_py()
            if k >= 0:
                first = int(counts[:k].sum())
                ids = np.concatenate([ids[:first], np.array([number], np.int32), ids[first + counts[k] :]])
                counts[k] = 1
        return np.searchsorted(starts, offsets, side="left"), coded.indices.to_numpy(), counts, ids

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        out = []
        for data, offsets in chunks(texts):
            first, word, counts, _ = self.words(data, offsets)
            total = np.concatenate([[0], np.cumsum(counts[word])])
            out.append(total[first[1:]] - total[first[:-1]])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some texts after another: the first token of each (and the end), flat ids."""
        for data, offsets in chunks(texts):
            first, word, counts, ids = self.words(data, offsets)
            lengths = counts[word]
            total = np.concatenate([[0], np.cumsum(lengths)])
            begin = np.cumsum(counts) - counts
            yield total[first], ids[ragged(begin[word], lengths)]

    def decode(self, first: np.ndarray, ids: np.ndarray) -> Iterator[bytes]:
        """The text of each sequence in UTF-8; bytes that aren't UTF-8 become U+FFFD."""
        k = 0
        while k < len(first) - 1:
            end = max(k + 1, int(np.searchsorted(first, first[k] + CHUNK_IDS, side="right")) - 1)
            buffers = self.token_bytes.take(pa.array(ids[first[k] : first[end]])).buffers()
            data = memoryview(buffers[2] or b"")
            offsets = np.frombuffer(buffers[1], np.int64, int(first[end] - first[k]) + 1)[first[k : end + 1] - first[k]]
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                yield str(data[a:b], "utf-8", "replace").encode()
            k = end


def chunks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A column's buffer and offsets, some megabytes at a time; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, edges, data = texts.buffers()
    offsets = np.frombuffer(edges, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(data if data is not None else b"", np.uint8)
    k = 0
    while k < len(texts):
        end = max(k + 1, int(np.searchsorted(offsets, offsets[k] + CHUNK_BYTES, side="right")) - 1)
        yield data, offsets[k : end + 1]
        k = end


@lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    """One table for each file and Python worker."""
    return ByteBpe(path)
