"""Byte-level BPE as a finite-state transducer, and streaming decode.

Encoding.  The ranked merges are compiled into a trie of the tokens that the
merges can really produce.  A sequence of tokens is the BPE result exactly when
every two neighbours are (merging the bytes of both gives the two back), so
every prefix of a text has one result, and the result of a longer text ends in
one token whose left neighbour closes a prefix.  Reading bytes from the left,
the transducer therefore follows every place where a token may still be open:
its state is the set of these places, each with its trie node and the last token
before it.  A place that lies more than the longest token back is closed, so
what all places agree on can be emitted after a bounded number of bytes.  States and transitions are worked
out when first met (lazy determinisation) and kept in tables of bounded size.

The new short pieces of a few texts are read together: their places are followed
on arrays, without making states of them.  Most of these pieces are rare words,
whose states are met once or twice and cost more to work out than they save.

Decoding.  Token bytes pass through a UTF-8 state machine that takes chunks cut
anywhere and holds back at most the three bytes of an unfinished character.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, text_or_empty

# Bounds of the tables; a full one is emptied and filled again.
MAX_MOVES = 500_000
MAX_PIECES = 300_000
# A longer piece is emitted in parts of so many bytes.
WINDOW = 4096
TOKEN_BITS = 20
TOKEN_MASK = (1 << TOKEN_BITS) - 1
LONGEST_CACHED_PIECE = 64
DECODE_CHUNK = 4096
# Texts of so many characters are split at once, and so many new pieces are read together.
GROUP_CHARS = 1 << 18
GROUP_PIECES = 8192


def load_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """Ranks from lines of base64 token and rank."""
    pairs = (line.split() for line in lines if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class NumberTable:
    """Numbers by number, looked up for arrays of them: open addressing, next slot if taken."""

    def __init__(self, bits: int = 12):
        self._clear(bits)

    def __len__(self) -> int:
        return self.used

    def _clear(self, bits: int) -> None:
        self.bits, self.used = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # wraps around
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values (from 0 on), -1 for a key that is not there."""
        slots = self._slots(keys)
        there = self.keys[slots]
        hit = there == keys
        found = np.where(hit, self.values[slots], -1)
        left = np.flatnonzero(~hit & (there >= 0))
        while left.size:
            slots[left] = at = (slots[left] + 1) & (len(self.keys) - 1)
            there = self.keys[at]
            hit = there == keys[left]
            found[left[hit]] = self.values[at[hit]]
            left = left[~hit & (there >= 0)]
        return found

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not in the table."""
        if (self.used + len(keys)) * 5 > len(self.keys) * 3:
            old = self.keys >= 0
            keys, values = np.concatenate([self.keys[old], keys]), np.concatenate([self.values[old], values])
            bits = self.bits
            while len(keys) * 5 > 3 << bits:
                bits += 1
            self._clear(bits)
        self.used += len(keys)
        slots = self._slots(keys)
        while keys.size:
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]  # one of those that meet on a slot gets it
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & (len(self.keys) - 1)


class Transducer:
    """Bytes in, token ids out, piece by piece of text."""

    def __init__(self, ranks: dict[bytes, int], max_moves: int = MAX_MOVES):
        self.ranks = ranks
        self.max_moves = max_moves
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.length_of = np.zeros(max(ranks.values()) + 1, np.int64)
        self.length_of[list(self.lengths)] = list(self.lengths.values())
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for single bytes {missing}")
        # Trie nodes: children by byte, and the token that ends there.  halves:
        # the two tokens whose merge gives a token.
        self.children: list[dict[int, int]] = [{}]
        self.ends = [-1]
        self.depths = [0]
        self.halves: dict[int, tuple[int, int]] = {}
        for token, rank in ranks.items():
            if len(token) > 1:
                merged = self._merge(token)
                if merged[0] != [rank]:
                    continue  # the merges never arrive at this token
                self.halves[rank] = merged[1]
            node = 0
            for byte in token:
                nxt = self.children[node].get(byte)
                if nxt is None:
                    nxt = len(self.children)
                    self.children[node][byte] = nxt
                    self.children.append({})
                    self.ends.append(-1)
                    self.depths.append(self.depths[node] + 1)
                node = nxt
            self.ends[node] = rank
        self.trie = NumberTable()
        edges = [(node << 8 | byte, nxt) for node, nexts in enumerate(self.children) for byte, nxt in nexts.items()]
        self.trie.add(*np.array(edges, np.int64).T)
        self.inner = np.array([bool(nexts) for nexts in self.children])
        self.end_of = np.array(self.ends, np.int64)
        if max(ranks.values()) >= 1 << TOKEN_BITS:
            raise ValueError(f"ids must be below {1 << TOKEN_BITS}")
        self.forget()

    def forget(self) -> None:
        """Drop what was worked out from the texts; the vocabulary's own tables stay."""
        self.neighbours: dict[int, bool] = {}
        self.pairs = NumberTable()  # the same for pieces read together
        self._clear()

    def _merge(self, piece: bytes) -> tuple[list[int], tuple[int, int] | None]:
        """The merges by definition: the pair of lowest rank first, leftmost on
        ties.  Ids, and the two that the last merge joined."""
        parts = [piece[k:k + 1] for k in range(len(piece))]
        ranks, last = self.ranks, None
        while len(parts) > 1:
            best = min((ranks.get(parts[k] + parts[k + 1], 1 << 60), k) for k in range(len(parts) - 1))
            if best[0] == 1 << 60:
                break
            last = parts[best[1]:best[1] + 2]
            parts[best[1]:best[1] + 2] = [last[0] + last[1]]
        return [ranks[p] for p in parts], last and (ranks[last[0]], ranks[last[1]])

    def _may_follow(self, left: int, right: int) -> bool:
        """``_follows``, kept for the pairs met before."""
        pair = left << TOKEN_BITS | right
        known = self.neighbours.get(pair)
        if known is None:
            if len(self.neighbours) >= self.max_moves:
                self.neighbours.clear()
            known = self.neighbours[pair] = self._follows(left, right)
        return known

    def _may_follow_all(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_may_follow`` for arrays."""
        pairs = left << TOKEN_BITS | right
        known = self.pairs.get(pairs)
        missing = np.flatnonzero(known < 0)
        if missing.size:
            new, place = np.unique(pairs[missing], return_inverse=True)
            found = np.array([self._follows(p >> TOKEN_BITS, p & TOKEN_MASK) for p in new.tolist()], np.int64)
            self.pairs.add(new, found)
            known[missing] = found[place]
        return known > 0

    def _follows(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives the two back.

        Both are taken apart again, the later merge (of higher rank) first; at
        each step the two parts that touch must not merge with each other
        before the merge that was just undone.  At equal ranks the pair that
        lies more to the left merges first.
        """
        ranks, token_bytes, halves = self.ranks, self.token_bytes, self.halves
        a, b, before = left, right, 1 << 60
        while True:
            if ranks.get(token_bytes[a] + token_bytes[b], 1 << 60) < before:
                return False
            if a in halves and (a > b or b not in halves):
                before, a = a, halves[a][1]
            elif b in halves:
                before, b = b + 1, halves[b][0]
            else:
                return True

    # A state is the places still open, the oldest first: by turns the trie node of
    # the bytes read since and the last token of the result up to there.  The last
    # place is the end of the bytes read so far, at node 0; it is kept without its
    # node, so a state ends in the last token of the result (-1 at the start).
    def _clear(self) -> None:
        start = (-1,)
        self.numbers = {start: 0}
        self.states = [start]
        # (state, byte) -> (next state, last token), each packed into one number.
        self.moves: dict[int, int] = {}

    def _number(self, state: tuple) -> int:
        number = self.numbers.setdefault(state, len(self.states))
        if number == len(self.states):
            self.states.append(state)
        return number

    def _move(self, number: int, byte: int) -> int:
        """Next state, and the last token of the result up to and with this byte, packed."""
        children, ends, known = self.children, self.ends, self.neighbours
        state = self.states[number]
        after, here, turns = [], -1, iter(state)
        for node, last in zip(turns, turns):
            node = children[node].get(byte)
            if node is not None:
                if here < 0:
                    token = ends[node]
                    if token >= 0:
                        follows = True if last < 0 else known.get(last << TOKEN_BITS | token)
                        if follows or follows is None and self._may_follow(last, token):
                            here = token
                if children[node]:
                    after += node, last
        last, node = state[-1], children[0][byte]
        if here < 0:
            here = ends[node]
            if last >= 0 and not self._may_follow(last, here):
                raise AssertionError("a prefix without a result")
        if children[node]:
            after += node, last
        after.append(here)
        return self._number(tuple(after)) << TOKEN_BITS | here

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        number, ends, lengths = 0, [], self.lengths
        for low in range(0, len(piece), WINDOW):
            if len(self.moves) > self.max_moves:  # keep the state, forget the table
                state = self.states[number]
                self._clear()
                number = self._number(state)
            moves = self.moves
            for byte in piece[low:low + WINDOW]:
                move = moves.get(number << 8 | byte)
                if move is None:
                    move = moves[number << 8 | byte] = self._move(number, byte)
                number = move >> TOKEN_BITS
                ends.append(move & TOKEN_MASK)
            if low + WINDOW < len(piece):
                ends = self._settle(number, ends, out)
        at, tail = len(ends), []
        while at:
            tail.append(ends[at - 1])
            at -= lengths[tail[-1]]
        return out + tail[::-1]

    def encode_together(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of short pieces, none of them empty."""
        out = [[whole] if (whole := self.ranks.get(piece)) is not None else None for piece in pieces]
        todo = [k for k, ids in enumerate(out) if ids is None]
        for low in range(0, len(todo), GROUP_PIECES):
            part = todo[low:low + GROUP_PIECES]
            for k, ids in zip(part, self._read_together([pieces[k] for k in part])):
                out[k] = ids
        return out

    def _read_together(self, pieces: list[bytes]) -> Iterator[list[int]]:
        if len(self.pairs) > self.max_moves:
            self.pairs = NumberTable()
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        lengths = np.array([len(p) for p in pieces])
        stops = np.cumsum(lengths)
        starts = stops - lengths
        left = np.repeat(stops, lengths) - np.arange(len(data))  # bytes from here to the piece's end
        # Every token of the trie from every byte on.
        at, nodes, size, found = np.arange(len(data)), np.zeros(len(data), np.int64), 0, []
        while at.size:
            nodes = self.trie.get(nodes << 8 | data[at + size])
            size += 1
            there = nodes >= 0
            at, nodes = at[there], nodes[there]
            tokens = self.end_of[nodes]
            ends = tokens >= 0
            found.append((at[ends], at[ends] + size - 1, tokens[ends]))
            on = self.inner[nodes] & (left[at] > size)
            at, nodes = at[on], nodes[on]
        first, final, tokens = (np.concatenate(parts) for parts in zip(*found))
        # The places in order: of the tokens that end at a byte, the one that may
        # follow the result before it is the last of the result up to that byte.
        offsets = first - np.repeat(starts, lengths)[first]
        order = np.argsort(offsets.astype(np.uint16) if lengths.max() < 1 << 16 else offsets, kind="stable")
        first, final, tokens = first[order], final[order], tokens[order]
        last, low = np.full(len(data), -1, np.int64), 0
        for offset, high in enumerate(np.cumsum(np.bincount(offsets)).tolist()):
            some = low + np.flatnonzero(last[final[low:high]] < 0)
            if offset:
                some = some[self._may_follow_all(last[first[some] - 1], tokens[some])]
            last[final[some]] = tokens[some]
            low = high
        if last.min() < 0:
            raise AssertionError("a prefix without a result")
        # From the ends of the pieces back to their starts, one token of each at a time.
        which, at, rounds = np.arange(len(pieces)), stops - 1, []
        while which.size:
            tokens = last[at]
            rounds.append((which, tokens))
            at = at - self.length_of[tokens]
            on = at >= starts[which]
            which, at = which[on], at[on]
        which, tokens = (np.concatenate(parts[::-1]) for parts in zip(*rounds))
        tokens = tokens[np.argsort(which, kind="stable")].tolist()
        cuts = [0, *np.cumsum(np.bincount(which)).tolist()]
        return (tokens[a:b] for a, b in zip(cuts, cuts[1:]))

    def _settle(self, number: int, ends: list[int], out: list[int]) -> list[int]:
        """Emit what all open places agree on; the last tokens of the prefixes after it."""
        lengths = self.lengths
        ways = []
        for node in (*self.states[number][:-1:2], 0):
            at, way = len(ends) - self.depths[node], []
            while at:
                way.append(at)
                at -= lengths[ends[at - 1]]
            ways.append(way[::-1])
        agreed = 0
        for cuts in zip(*ways):
            if len(set(cuts)) > 1:
                break
            out.append(ends[cuts[0] - 1])
            agreed = cuts[0]
        return ends[agreed:]


class Utf8Stream:
    """Incremental UTF-8: text out as soon as characters are complete."""

    def __init__(self) -> None:
        self.held = b""

    def feed(self, chunk: bytes) -> str:
        data = self.held + chunk
        cut = len(data) - self._unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Number of bytes at the end that begin a character and do not complete it."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue
            need = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
            return back if need > back else 0
        return 0


class Codec:
    """Texts to ids and back, with a bounded table of pieces met before."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_pieces: int = MAX_PIECES):
        self.transducer = Transducer(ranks)
        self.find = regex.compile(pattern).findall
        self.pieces: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.max_pieces = max_pieces
        self.names = {rank: str(rank) for rank in self.transducer.token_bytes}

    def forget(self) -> None:
        """Drop the tables of what was met in the texts."""
        self.transducer.forget()
        self.pieces, self.older = {}, {}

    def _learn(self, pieces: dict[str, str | None]) -> None:
        """Fill in the ids of the pieces that have none."""
        names = self.names.__getitem__
        short = [piece for piece, ids in pieces.items() if ids is None and len(piece) <= LONGEST_CACHED_PIECE]
        together = self.transducer.encode_together([piece.encode("utf-8", "replace") for piece in short])
        pieces.update(zip(short, [",".join(map(names, ids)) for ids in together]))
        for piece, ids in pieces.items():
            if ids is None:
                pieces[piece] = ",".join(map(names, self.transducer.encode(piece.encode("utf-8", "replace"))))

    def _encode_group(self, texts: list[str]) -> list[str]:
        rows, gaps, new = [], [], {}
        for text in texts:
            pieces = self.find(text)
            ids = list(map(self.pieces.get, pieces))
            missing = [(k, pieces[k]) for k, known in enumerate(ids) if known is None]
            new.update((piece, None) for _, piece in missing)
            rows.append(ids)
            gaps.append(missing)
        back = [(piece, self.older[piece]) for piece in new if piece in self.older]
        new.update(back)
        self._learn(new)
        for ids, missing in zip(rows, gaps):
            for k, piece in missing:
                ids[k] = new[piece]
        if len(self.pieces) + len(new) > self.max_pieces // 2:
            # Pieces that come again are taken over from the half that is on its way out.
            self.older, self.pieces = self.pieces, {}
        if len(new) <= self.max_pieces // 2:
            self.pieces.update((piece, ids) for piece, ids in new.items() if len(piece) <= LONGEST_CACHED_PIECE)
        return [",".join(ids) for ids in rows]

    def encode_all(self, texts: list[str]) -> list[str]:
        """Ids as decimals joined by commas, text by text."""
        out, group, size = [], [], 0
        for text in texts:
            if group and size + len(text) > GROUP_CHARS:
                out += self._encode_group(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        return out + self._encode_group(group)

    def encode(self, text: str) -> str:
        """Ids as decimals joined by commas."""
        return self.encode_all([text])[0]

    def decode(self, ids: str) -> Iterable[tuple[bytes, str]]:
        """Chunks of decoded bytes and the characters that are complete with them."""
        stream, numbers = Utf8Stream(), np.fromstring(ids, np.int64, sep=",") if ids else ()
        for low in range(0, len(numbers), DECODE_CHUNK):
            chunk = b"".join(map(self.transducer.token_bytes.__getitem__, numbers[low:low + DECODE_CHUNK].tolist()))
            yield chunk, stream.feed(chunk)
        if stream.held:
            yield b"", stream.finish()


_codecs: dict[tuple[int, str], Codec] = {}


def codec_of(blob: bytes, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    key = (hash(blob), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(load_ranks(blob.splitlines()), pattern)
    return _codecs[key]


def forget_texts() -> None:
    """Free what this worker process learned from a task's texts.

    Idle workers outlive their stage, and full tables would add a few hundred MB
    a worker to what later stages need.
    """
    for codec in _codecs.values():
        codec.forget()


def share_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The rank file, read on the driver (a vocabulary is a megabyte or so) for all executors."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_documents(docs: DataFrame, vocabulary: Broadcast, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, token_ids]): one row per input row.

    A null or empty text has no tokens (the digests are those of no bytes).
    Matches of ``pattern`` are encoded one by one, special tokens are ordinary
    text.  The ids are decoded again; a text that does not come back stops the
    job.  Repeated rows each stay, a null id stays null, other columns are
    ignored.
    """

    def make():
        codec = codec_of(vocabulary.value, pattern)

        def step(ids, texts):
            counts, id_digests, byte_digests, lists = [], [], [], []
            for text, encoded in zip(texts, codec.encode_all(texts), strict=True):
                digest = hashlib.sha256()
                chars = 0
                for chunk, characters in codec.decode(encoded):
                    digest.update(chunk)
                    chars += len(characters)
                if chars != len(text):
                    raise ValueError(f"a text of {len(text)} characters came back with {chars}")
                counts.append(encoded.count(",") + 1 if encoded else 0)
                id_digests.append(hashlib.sha256(encoded.encode("ascii")).hexdigest())
                byte_digests.append(digest.hexdigest())
                if with_ids:
                    lists.append(list(map(int, encoded.split(","))) if encoded else [])
            return [ids, counts, id_digests, byte_digests] + ([lists] if with_ids else [])
        return step

    kind = docs.schema[id_col].dataType.simpleString()
    schema = "id " + kind + ", n_tokens long, ids_sha256 string, decoded_sha256 string" + (", token_ids array<int>" if with_ids else "")
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return map_rows(source, ["id", "text"], schema, make, end=forget_texts).withColumnRenamed("id", id_col)
