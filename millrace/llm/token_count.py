"""Token counts by a deterministic transducer compiled from a BPE vocabulary.

The transducer reads characters. A transition carries how many tokens the encoding of the text read so far gains (or loses,
where a merge swallows tokens). What a state must know is finite: which vocabulary pieces are still open at the end of the
text, which token stands before each of them, and how many tokens the encoding had there. The last token of an encoding is
the one piece that ends here and whose predecessor accepts it as neighbour, so one character of input decides the next state.
States are made when first reached.

White space can only begin a piece. The transducer is therefore back in its start state before every run of white space,
whatever came earlier, and the state map of a chunk is fully described by three things: the characters before its first such
place (still to be read from an unknown state), the tokens from there to the last one, and the characters after it. Two
chunk maps compose into one of the same form; a prefix scan over the chunks of a text gives the count at every border.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import map_texts

SPACE = "▁"  # fixed value: how the vocabulary writes a space
CHUNK = 65_536  # characters
REMEMBERED = 400_000  # words, and states, that a task remembers before it starts afresh
NEVER = float("inf")
NORMAL = 1  # fixed value: the type of ordinary pieces in a model file


def read_pieces(path: str) -> dict[str, float]:
    """The ordinary pieces of a BPE model file and their scores; refuses models this transducer does not fit."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    spec, norm = model.trainer_spec, model.normalizer_spec
    plain = norm.name == "identity" and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
    if spec.model_type != 2 or not spec.byte_fallback or spec.treat_whitespace_as_suffix or not plain:
        raise ValueError("only BPE models with byte fallback and no text normalisation are supported")
    pieces = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
    if any(SPACE in p.lstrip(SPACE) for p in pieces) or any(p.type == 4 for p in model.pieces):
        raise ValueError("pieces must not go on after a space, nor be set by the user")
    return pieces


class Transducer:
    """`step[state][character]` is (next state, tokens gained); state 0 is the start."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.rank = {piece: -score for piece, score in pieces.items()}
        self.trie: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        for piece in {*pieces, *(c for p in pieces for c in p)}:
            if len(piece) == 1 or self.merged(piece) == [piece]:
                node = 0
                for c in piece:
                    after = self.trie[node].get(c)
                    if after is None:
                        after = self.trie[node][c] = len(self.trie)
                        self.trie.append({})
                        self.ends.append(None)
                    node = after
                self.ends[node] = piece
        self._stable: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        start = ((0, None, 0),)
        self.states: list[tuple] = [start]
        self.number: dict[tuple, int] = {start: 0}
        self.step: list[dict[str, tuple[int, int]]] = [{}]

    def merged(self, text: str) -> list[str]:
        """The definition: merge the adjacent pair of best score, leftmost first, until none is left."""
        parts, rank = list(text), self.rank.get
        order = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while order and (best := min(order)) < NEVER:
            at = order.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del order[at]
            if at:
                order[at - 1] = rank(parts[at - 1] + parts[at], NEVER)
            if at < len(order):
                order[at] = rank(parts[at] + parts[at + 1], NEVER)
        return parts

    def stable(self, left: str, right: str) -> bool:
        known = self._stable.get((left, right))
        if known is None:
            if len(self._stable) > REMEMBERED:
                self._stable.clear()
            both = left + right
            known = self._stable[left, right] = both not in self.pieces and self.merged(both) == [left, right]
        return known

    def cost(self, token: str) -> int:
        return 1 if token in self.pieces else len(token.encode())

    def compile(self, state: int, c: str) -> tuple[int, int]:
        """Make the transition for one character; tokens before open pieces are kept relative to the count here."""
        opened, gained, last = [], 0, None
        for node, before, count in self.states[state]:
            child = self.trie[node].get(c)
            if child is None:
                continue
            opened.append((child, before, count))
            token = self.ends[child]
            if last is None and token is not None and (before is None or self.stable(before, token)):  # one piece at most
                gained, last = count + self.cost(token), token
        if last is None:  # no piece has this character: its bytes, and nothing merges across it
            opened, gained = [], self.states[state][-1][2] + len(c.encode())
        after = (*((node, before, count - gained) for node, before, count in opened if self.trie[node]), (0, last, 0))
        at = self.number.get(after)
        if at is None:
            at = self.number[after] = len(self.states)
            self.states.append(after)
            self.step.append({})
        found = self.step[state][c] = (at, gained)
        return found

    def count(self, text: str) -> int:
        """Tokens of a text read from the start state."""
        if len(self.states) > REMEMBERED:
            self.reset()
        state, tokens, step = 0, 0, self.step
        for c in text:
            move = step[state].get(c)
            state, gained = move if move is not None else self.compile(state, c)
            tokens += gained
        return tokens


class ChunkMap(NamedTuple):
    """State map of a chunk; `whole` if it has no place where the start state is certain (then all of it is in `head`)."""

    head: str
    tokens: int
    tail: str
    whole: bool


class Counter(dict):
    """Counts words through the transducer, each distinct one once; composes chunk maps."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, word: str) -> int:
        n = self.transducer.count(word)
        if len(word) <= 32:
            self[word] = n
        return n

    def spread(self, text: str) -> int:
        """Tokens of a text that begins where the start state is certain, cut at every further such place."""
        words = text.split(SPACE)
        if "" not in words[1:]:
            return sum(map(self.__getitem__, [SPACE + w for w in words[1:]])) + (self[words[0]] if words[0] else 0)
        total, spaces = self[words[0]] if words[0] else 0, ""
        for word in words[1:]:
            spaces += SPACE
            if word:
                total, spaces = total + self[spaces + word], ""
        return total + (self[spaces] if spaces else 0)

    def chunk_map(self, chunk: str) -> ChunkMap:
        first = next((i for i in range(1, len(chunk)) if chunk[i] == SPACE and chunk[i - 1] != SPACE), None)
        if first is None:
            return ChunkMap(chunk, 0, "", True)
        last = len(chunk)
        while True:  # the last space that does not follow a space
            last = chunk.rfind(SPACE, 0, last)
            if chunk[last - 1] != SPACE:
                break
        return ChunkMap(chunk[:first], self.spread(chunk[first:last]) if last > first else 0, chunk[last:], False)

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a.whole and b.whole:
            both = self.chunk_map(a.head + b.head)
            return both
        if a.whole:
            left = self.chunk_map(a.head + b.head)
            if left.whole:
                return ChunkMap(left.head, b.tokens, b.tail, False)
            return ChunkMap(left.head, left.tokens + self.spread(left.tail) + b.tokens, b.tail, False)
        middle = self.chunk_map(a.tail + b.head)
        if b.whole:
            return ChunkMap(a.head, a.tokens, middle.head, False) if middle.whole else ChunkMap(
                a.head, a.tokens + self.spread(middle.head) + middle.tokens, middle.tail, False)
        return ChunkMap(a.head, a.tokens + self.spread(a.tail + b.head) + b.tokens, b.tail, False)

    def scan(self, maps: list[ChunkMap]) -> list[ChunkMap]:
        """All prefix compositions, in log2 rounds whose steps do not depend on each other."""
        done, reach = list(maps), 1
        while reach < len(done):
            done = done[:reach] + [self.compose(done[i - reach], done[i]) for i in range(reach, len(done))]
            reach *= 2
        return done

    def total(self, m: ChunkMap) -> int:
        return (self.spread(m.head) if m.head else 0) + m.tokens + (self.spread(m.tail) if m.tail else 0)

    def tokens(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a text as the vocabulary's own library counts them."""
        if not text:
            return 0
        escaped = SPACE + text.replace(" ", SPACE)
        if len(escaped) <= chunk:
            return self.spread(escaped)
        return self.total(self.scan([self.chunk_map(escaped[i:i + chunk]) for i in range(0, len(escaped), chunk)])[-1])


def start(pieces: dict[str, float]) -> Callable[[list, list], dict]:
    counter = Counter(Transducer(pieces))

    def rows(ids: list, texts: list) -> dict:
        counts = []
        for text in texts:
            if len(counter) > REMEMBERED:
                counter.clear()
            counts.append(counter.tokens(text))
        return {"doc_id": ids, "n_bytes": [len(t.encode()) for t in texts], "n_tokens": counts}

    return rows


def counted(docs: DataFrame, pieces: dict[str, float], limit: int = 4096) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` of every whole text.

    NULL and empty texts have no tokens. One row per row of `docs`, repeated rows included; other columns are not looked at.
    Nothing is shuffled.
    """
    rows = map_texts(docs, lambda: start(pieces), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
