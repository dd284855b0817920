"""SentencePiece encoding and decoding over a trie of distinct marked words, depth-first, with shared forward states."""

from __future__ import annotations

import gc
import hashlib
import heapq
import math
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernel
from .shared import lean, small_batches

#: The vocabulary file of a public tokenizer; a parameter of every function here.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Piece types of the model format, as stated in its public schema.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Distinct words, and pairs of pieces, that a worker remembers between batches; beyond it forgets words used once, or starts anew. They bound
#: memory and change no result.
REMEMBERED, PAIRS = 150_000, 300_000
#: Bytes of text whose words are sorted together.
CHUNK = 1 << 20
#: Characters up to which a word's pairs are looked through anew after each merge; longer ones keep them in a heap.
SHORT = 24


def _fields(data: bytes):
    """Field number and value of each field of a protocol-buffer message."""

    def varint(i):
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            i, shift = i + 1, shift + 7
            if data[i - 1] < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        if key & 7 == 0:
            value, i = varint(i)
        elif key & 7 == 2:
            n, i = varint(i)
            value, i = data[i : i + n], i + n
        else:
            n = 4 if key & 7 == 5 else 8
            value, i = data[i : i + n], i + n
        yield key >> 3, value


class Model:
    """Pieces, scores and flags of a SentencePiece model file."""

    def __init__(self, data: bytes):
        self.pieces, self.scores, self.types = [], [], []
        self.kind, self.prefix, self.squeeze, self.charsmap, falls_back = UNIGRAM, True, True, b"", False
        for field, value in _fields(data):
            if field == 1:
                got = dict(_fields(value))
                self.pieces.append(got.get(1, b"").decode())
                self.scores.append(float(np.frombuffer(got[2], "<f4")[0]) if 2 in got else 0.0)
                self.types.append(got.get(3, NORMAL))
            elif field == 2:
                got = dict(_fields(value))
                self.kind, falls_back = got.get(3, UNIGRAM), bool(got.get(35, 0))
            elif field == 3:
                got = dict(_fields(value))
                self.prefix, self.squeeze, self.charsmap = bool(got.get(3, 1)), bool(got.get(4, 1)), got.get(2, b"")
        if self.charsmap:
            raise ValueError("models with a character map are not supported; identity normalisation only")
        usable = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t in (NORMAL, USER)}
        self.ids = usable
        if any(MARK in p.lstrip(MARK) for p in usable):
            raise ValueError("a piece crosses words")
        self.bytes = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE and falls_back}
        self.unk = self.types.index(UNKNOWN)
        self.known = {p for p in usable if len(p) == 1}
        low = min((s for s, t in zip(self.scores, self.types) if t == NORMAL), default=0.0)
        self.unk_score = low - 10.0
        self.valid: list[dict[int, bool]] = [{} for _ in self.pieces]
        self.seen = 0

    def fallback(self, text: str) -> list[int]:
        """Ids of characters that no piece covers: their bytes, or one unknown piece for all of them."""
        return [self.bytes[b] for b in text.encode()] if self.bytes else [self.unk] if text else []

    # -- byte-pair models

    def merge(self, word: str) -> list[int]:
        """Plain byte-pair encoding of known characters: again and again the leftmost adjacent pair whose union scores highest. Pairs wait
        in a heap; each merge joins two links of a list, so long runs take n log n."""
        if len(word) <= SHORT:
            return self._merge_short(word)
        parts: list[str | None] = list(word)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] < len(parts):
                both = parts[k] + parts[after[k]]
                i = self.ids.get(both)
                if i is not None:
                    heapq.heappush(heap, (-self.scores[i], k, both))

        for k in range(len(parts) - 1):
            offer(k)
        while heap:
            _, k, both = heapq.heappop(heap)
            nxt = after[k]
            if parts[k] is None or nxt >= len(parts) or parts[k] + parts[nxt] != both:
                continue  # one of its halves has merged otherwise since
            parts[k], parts[nxt], after[k] = both, None, after[nxt]
            if after[k] < len(parts):
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [self.ids[p] for p in parts if p is not None]

    def _merge_short(self, word: str) -> list[int]:
        parts, ids, scores = list(word), self.ids, self.scores
        while len(parts) > 1:
            best, at = -math.inf, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and scores[i] > best:
                    best, at = scores[i], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ids[p] for p in parts]

    def follows(self, a: int, b: int) -> bool:
        """Whether piece b may stand after piece a: together they encode to just these two."""
        if self.seen > PAIRS:
            for row in self.valid:
                row.clear()
            self.seen = 0
        self.seen += 1
        got = self.valid[a][b] = self.merge(self.pieces[a] + self.pieces[b]) == [a, b]
        return got

    def automaton(self) -> dict:
        """The trie of pieces: a node is a dict of next nodes by character, with the piece that ends there under 0. For a byte-pair model
        pieces that their own encoding doesn't reach are left out."""
        if not hasattr(self, "_trie"):
            self._trie: dict = {}
            for p, i in self.ids.items():
                if self.kind == BPE and len(p) > 1 and self.merge(p) != [i]:
                    continue
                node = self._trie
                for c in p:
                    node = node.setdefault(c, {})
                node[0] = i
        return self._trie

    # -- depth-first over sorted words

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """Ids of each of the sorted distinct words: of known characters, or with a unigram model of any, where -1 stands for a character
        that no piece covers.

        Neighbours in sorted order are neighbours on the trie; walking them keeps a stack with one forward state per character of the
        current path and cuts it back to the common prefix, so no prefix is computed twice. For a unigram model the state is the best
        score and the length of the last piece (Viterbi). For a byte-pair model it is the last piece of the prefix's encoding: the one
        that may follow the encoding of what stands before it.
        """
        out, before = [], ""
        size = [len(p) for p in self.pieces] + [1]  # the last one is that of -1
        extend = self._viterbi if self.kind == UNIGRAM else self._followed
        # state after each prefix of the path: score, piece that ends there, and (start, node) of the pieces that may still go on
        score, last, open_ = [0.0], [-1], [[]]
        for word in words:
            same = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                same += 1
            del score[same + 1 :], last[same + 1 :], open_[same + 1 :]
            extend(word, same, score, last, open_)
            got, end = [], len(word)
            while end > 0:
                i = last[end]
                got.append(i)
                end -= size[i]
            got.reverse()
            out.append(got)
            before = word
        return out

    def _viterbi(self, word: str, begin: int, score: list, last: list, open_: list) -> None:
        root, scores, alive = self.automaton(), self.scores, open_[begin]
        for end in range(begin, len(word)):
            c, best, at, live = word[end], -math.inf, -1, []
            for start, node in [*alive, (end, root)]:  # longest first
                node = node.get(c)
                if node is not None:
                    live.append((start, node))
                    i = node.get(0)
                    if i is not None:
                        s = score[start] + scores[i]
                        if s > best:
                            best, at = s, i
            single = live and live[-1][0] == end and 0 in live[-1][1]
            if not single and score[end] + self.unk_score > best:
                best, at = score[end] + self.unk_score, -1
            score.append(best)
            last.append(at)
            open_.append(live)
            alive = live

    def _followed(self, word: str, begin: int, score: list, last: list, open_: list) -> None:
        root, valid, follows, alive = self.automaton(), self.valid, self.follows, open_[begin]
        for end in range(begin, len(word)):
            c, at, live = word[end], -1, []
            for start, node in alive:  # longest first
                node = node.get(c)
                if node is not None:
                    i = node.get(0)
                    if i is None or len(node) > 1:  # some piece goes on
                        live.append((start, node))
                    if at < 0 and i is not None:
                        if not start:
                            at = i
                        elif (a := last[start]) < 0:
                            pass
                        elif (ok := valid[a].get(i)) or ok is None and follows(a, i):
                            at = i
            node = root.get(c)
            if node is not None:
                i = node.get(0)
                if i is None or len(node) > 1:
                    live.append((end, node))
                if at < 0 and i is not None:
                    a = last[end]
                    if a < 0:
                        if end == 0:
                            at = i
                    elif (ok := valid[a].get(i)) or ok is None and follows(a, i):
                        at = i
            last.append(at)
            open_.append(live)
            alive = live

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Ids of distinct marked words of any characters."""
        parts = {w: self.word.findall(w) for w in words}
        got = self.encode_units({u for p in parts.values() for u in p})
        return {w: [i for u in p for i in got[u]] for w, p in parts.items()}

    def encode_units(self, units: set[str]) -> dict[str, list[int]]:
        """Ids of distinct parts that the pattern `word` gives."""
        if self.kind == UNIGRAM:
            order = sorted(units)
            return {w: self.covered(w, ids) if -1 in ids else ids for w, ids in zip(order, self.encode_sorted(order))}
        known, twice = self.known, MARK * 2
        plain = sorted(u for u in units if u[0] in known and not u.startswith(twice))
        got = dict(zip(plain, self.encode_sorted(plain)))
        for u in units - got.keys():  # runs of marks, whose pieces tie in score, are merged step by step
            got[u] = self.merge(u) if u[0] in known else self.fallback(u)
        return got

    def covered(self, word: str, ids: list[int]) -> list[int]:
        """ids with each run of -1 replaced by what its characters fall back to."""
        out, at, begin = [], 0, None
        for i in [*ids, None]:
            if i == -1:
                begin = at if begin is None else begin
                at += 1
                continue
            if begin is not None:
                out += self.fallback(word[begin:at])
                begin = None
            if i is not None:
                out.append(i)
                at += len(self.pieces[i])
        return out

    @property
    def word(self) -> re.Pattern:
        """What is encoded as a whole: marks with what follows them, or what stands before the first mark. A byte-pair model's pieces don't
        cross characters that have none, so its words end there, too; that keeps the distinct ones few."""
        if not hasattr(self, "_word"):
            self._word = WORD
            if self.kind == BPE:
                chars = "".join(map(re.escape, sorted(self.known - {MARK})))
                self._word = re.compile(f"{MARK}+[{chars}]*|[{chars}]+|[^{chars}{MARK}]+")
        return self._word

    def marked(self, text: str) -> str:
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)

    def decode(self, ids: list[int]) -> str:
        """Text of ids; byte pieces are joined to UTF-8, invalid ones become U+FFFD, control pieces vanish."""
        out = bytearray()
        for i in ids:
            t = self.types[i]
            if t == BYTE:
                out.append(int(self.pieces[i][3:5], 16))
            elif t == UNKNOWN:
                out += " ⁇ ".encode()
            elif t != CONTROL:
                out += self.pieces[i].encode()
        text = out.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


#: A mark with what follows it, or the piece of text before the first mark.
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_tables: dict[bytes, "_Table"] = {}


def read(path: str) -> bytes:
    """The model file's bytes. They go to the executors with the job, which need no file of their own."""
    with open(path, "rb") as f:
        return f.read()


class _Table:
    """Words by number, with the ids of their pieces in one flat array that grows as needed."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number, self.used = {}, 0
        self.flat, self.begin, self.lengths, self.uses = np.zeros(1 << 16, np.int32), *(np.zeros(1 << 14, np.int64) for _ in range(3))

    def shrink(self) -> None:
        """Forgets the words that have been used just once; all, if too many are left."""
        n = len(self.number)
        keep = np.flatnonzero(self.uses[:n] > 1)
        if len(keep) > REMEMBERED // 2:
            self.clear()
            return
        names, flat = list(self.number), _gather(self.flat, self.begin, self.lengths, keep)
        lengths = self.lengths[keep]
        self.clear()
        self.number = {names[k]: at for at, k in enumerate(keep.tolist())}
        self.flat, self.used = flat, len(flat)
        self.lengths, self.begin, self.uses = lengths, np.cumsum(lengths) - lengths, np.ones(len(keep), np.int64)

    def add(self, words: set[str]) -> None:
        new = words - self.number.keys()
        if len(self.number) + len(new) > REMEMBERED:
            self.shrink()
            new = words - self.number.keys()
        if not new:
            return
        got = self.model.encode_units(new)
        count = np.fromiter(map(len, got.values()), np.int64, len(got))
        flat = np.fromiter(chain.from_iterable(got.values()), np.int32, int(count.sum()))
        n, m = len(self.number), self.used + len(flat)
        if m > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(m, np.int32)])
        if n + len(got) > len(self.begin):
            more = np.zeros(n + len(got), np.int64)
            self.begin, self.lengths, self.uses = (np.concatenate([x, more]) for x in (self.begin, self.lengths, self.uses))
        self.flat[self.used : m] = flat
        self.lengths[n : n + len(got)] = count
        self.begin[n : n + len(got)] = self.used + np.cumsum(count) - count
        self.number.update(zip(got, range(n, n + len(got))))
        self.used = m


def table_of(data: bytes) -> _Table:
    """This worker's model and table, kept from task to task."""
    name = hashlib.sha256(data).digest()
    if name not in _tables:
        _tables.clear()
        _tables[name] = _Table(Model(data))
    return _tables[name]


def _gather(flat: np.ndarray, begin: np.ndarray, lengths: np.ndarray, pick: np.ndarray) -> np.ndarray:
    n = lengths[pick]
    total = np.cumsum(n)
    shift = np.repeat(begin[pick] - (total - n), n)
    return flat[np.arange(int(total[-1]) if len(n) else 0) + shift]


def piece_bytes(model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decoded bytes of all pieces, flat, with begins and lengths."""
    each = []
    for p, t in zip(model.pieces, model.types):
        if t == BYTE:
            each.append(bytes([int(p[3:5], 16)]))
        elif t == CONTROL:
            each.append(b"")
        elif t == UNKNOWN:
            each.append(" ⁇ ".encode())
        else:
            each.append(p.replace(MARK, " ").encode())
    lengths = np.array([len(x) for x in each], np.int64)
    return np.frombuffer(b"".join(each), np.uint8), np.concatenate([[0], np.cumsum(lengths)])[:-1], lengths


def encode_column(table: _Table, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of a list of texts and their offsets."""
    model = table.model
    split = model.word.findall
    words = [split(model.marked(t)) for t in texts]
    table.add(set().union(*words))
    pick = np.fromiter(map(table.number.__getitem__, chain.from_iterable(words)), np.int64, sum(map(len, words)))
    table.uses += np.bincount(pick, minlength=len(table.uses))
    per_word = np.concatenate([[0], np.cumsum(table.lengths[pick])])
    at = np.concatenate([[0], np.cumsum([len(x) for x in words])])
    return _gather(table.flat, table.begin, table.lengths, pick), per_word[at]


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """docs(doc_id, text, ...) without text, and: n_tokens, token_ids, round_trip (the ids decode to the very text).

    One pass without a shuffle. Each worker takes about a megabyte of text at a time (CHUNK), splits it into marked words, encodes the
    distinct ones it hasn't met along the trie, and puts texts together by number. Null texts get null ids, no tokens and a null
    round_trip; empty ones no ids; repeated rows come back each; other columns pass through, but for n_tokens, token_ids and
    round_trip, which are replaced. With a model that squeezes spaces the round trip is to the squeezed text.
    """
    small_batches(docs.sparkSession)
    docs, model_file = docs.drop("n_tokens", "token_ids", "round_trip"), read(path)
    at = docs.columns.index("text")
    others = [k for k, c in enumerate(docs.columns) if c != "text"]
    names = [*(docs.columns[k] for k in others), "n_tokens", "token_ids", "round_trip"]

    def run(batches):
        gc.disable()  # millions of small lists, none in a cycle
        try:
            yield from encoded(batches)
        finally:
            gc.enable()

    def encoded(batches):
        table = table_of(model_file)
        model = table.model
        flat, begin, lengths = piece_bytes(model)
        for batch in batches:
            _, offsets = kernel.buffers(batch.column(at))
            for i, j in kernel.chunks(offsets, CHUNK):
                part = batch.slice(i, j - i)
                raw = part.column(at).to_pylist()
                texts = [t or "" for t in raw]
                ids, ends = encode_column(table, texts)
                data = _gather(flat, begin, lengths, ids).tobytes()
                size = np.concatenate([[0], np.cumsum(lengths[ids])])[ends].tolist()
                skip = 1 if model.prefix else 0
                same = []
                for k, t in enumerate(texts):
                    want = " ".join(x for x in t.split(" ") if x) if model.squeeze else t
                    same.append(None if raw[k] is None else data[size[k] + (skip if t else 0) : size[k + 1]] == want.encode())
                null = pa.array([t is None for t in raw])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                if any(t is None for t in raw):
                    lists = pa.array([None if n else x for n, x in zip(null.to_pylist(), lists.to_pylist())], pa.list_(pa.int32()))
                yield pa.record_batch(
                    [*(part.column(k) for k in others), pa.array(np.diff(ends)), lists, pa.array(same, pa.bool_())],
                    names,
                )

    schema = ", ".join(f"`{docs.schema[k].name}` {docs.schema[k].dataType.simpleString()}" for k in others)
    return docs.mapInArrow(lean(run), f"{schema}, n_tokens long, token_ids array<int>, round_trip boolean")


def decode(tokens: DataFrame, path: str = MODEL) -> DataFrame:
    """All columns of tokens(token_ids, ...) and text, which replaces a column of that name; null ids give a null text."""
    small_batches(tokens.sparkSession)
    tokens, model_file = tokens.drop("text"), read(path)
    at = tokens.columns.index("token_ids")

    def run(batches):
        model = table_of(model_file).model
        for batch in batches:
            texts = [None if x is None else model.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema)
    return tokens.mapInArrow(run, f"{schema}, text string")
