"""Byte-level BPE: a lazily determinised transducer for encoding, a UTF-8 state machine for decoding.

Encoding.  A token sequence is what merging by rank gives exactly if each two neighbours,
merged alone from their joint bytes, come out as those two tokens again.  So each prefix of
the input has one last token, and the merges can be run left to right: the nondeterministic
machine guesses a token boundary and then reads a token in the vocabulary's trie.  Its
determinisation is built on demand: a state is the set of boundaries from which a token can
still be read (trie node, token that ended there), a transition is remembered by (state,
byte) and yields the last token of the prefix it completes.  Following last tokens back
from all live boundaries, the paths meet; tokens before that point are final and emitted, at
the latest every ``LOOKAHEAD`` bytes plus the length of a token.  Each match of the
splitting pattern is encoded by itself; a match that is a token is emitted whole.

Decoding.  Tokens are read one by one; the machine's state is the incomplete UTF-8 sequence
carried over (at most three bytes), its output the characters completed by the token.

Memory is bounded: states, remembered pieces and token pairs are dropped once a table is
full, and texts are read in runs of ``RUN`` pieces.  Null text is the empty text (no tokens);
repeated rows are encoded alike; an empty table gives an empty result; other columns of the
input are ignored.  The rank file is a parameter and is read on each executor.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from itertools import chain, islice

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweather.llm.common import table, tidy

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
MAX_STATES = 100_000
MAX_PIECES = 250_000
LOOKAHEAD = 256  # bytes
LONG_PIECE = 64  # bytes; longer ones are not remembered
RUN = 50_000
NEVER = 1 << 60  # rank of two parts that do not merge

# The public pattern for texts below U+0250, spelled out for the faster re module.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-\u024f", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
LATIN_PATTERN = f"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
NOT_LATIN = re.compile("[^\x00-\u024f]")

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, decoded_chars bigint"


class Transducer:
    """Encoder of one byte string at a time; ``ranks`` maps token bytes to ids in merge order."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.length = {i: len(b) for b, i in ranks.items()}
        # Trie of the tokens: (node, byte) packed into one number gives the next node.
        self.child: dict[int, int] = {}
        self.token_at, self.depth, self.inner = [-1], [0], [True]
        for token, i in ranks.items():
            node = 0
            for d, c in enumerate(token, 1):
                self.inner[node] = True
                step = self.child.get(node << 8 | c)
                if step is None:
                    step = self.child[node << 8 | c] = len(self.token_at)
                    self.token_at.append(-1)
                    self.depth.append(d)
                    self.inner.append(False)
                node = step
            self.token_at[node] = i
        self.agrees: dict[tuple[int, int], bool] = {}
        self.built: dict[int, tuple] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states but the first: one boundary at the start, at the trie's root."""
        self.states = [((0, -1),)]
        self.number = {self.states[0]: 0}
        self.steps: list[dict[int, tuple[int, int]]] = [{}]

    def events(self, token: int) -> tuple[bool, list[int], list[bytes], list[bytes]]:
        """How merging builds a token from its bytes: whether it does, the merges' ranks in order,
        and the outermost left and right part before each merge and at the end."""
        known = self.built.get(token)
        if known is None:
            data = self.bytes_of[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            order, left, right = [], [parts[0]], [parts[-1]]
            while len(parts) > 1:
                best, i = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
                if best == NEVER:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                order.append(best)
                left.append(parts[0])
                right.append(parts[-1])
            known = self.built[token] = len(parts) == 1, order, left, right
        return known

    def agree(self, left: int, right: int) -> bool:
        """Whether merging the joint bytes gives these two tokens (left -1: the start).

        Both sides' merges run in order of rank (the left one first at a tie) until a merge
        across the boundary would come before either side's next one.
        """
        whole, order_r, edge_r, _ = self.events(right)
        if left < 0 or not whole:
            return whole
        whole, order_l, _, edge_l = self.events(left)
        if not whole:
            return False
        i = j = 0
        while True:
            next_l = order_l[i] if i < len(order_l) else NEVER
            next_r = order_r[j] if j < len(order_r) else NEVER
            across = self.ranks.get(edge_l[i] + edge_r[j], NEVER)
            if across < next_l and across <= next_r and across < NEVER:
                return False
            if next_l == next_r == NEVER:
                return True
            if next_l <= next_r:
                i += 1
            else:
                j += 1

    def may_follow(self, left: int, right: int) -> bool:
        known = self.agrees.get((left, right))
        if known is None:
            if len(self.agrees) > 5 * MAX_PIECES:
                self.agrees.clear()
            known = self.agrees[left, right] = self.agree(left, right)
        return known

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """Determinise one transition: the next state and the last token of the prefix so far."""
        if len(self.states) > MAX_STATES:
            at = self.states[state]
            self.reset()
            state = self.intern(at)
        live, last = [], -1
        for node, token in self.states[state]:
            node = self.child.get(node << 8 | byte, -1)
            if node < 0:
                continue
            if last < 0 and self.token_at[node] >= 0 and self.may_follow(token, self.token_at[node]):
                last = self.token_at[node]
            if self.inner[node]:
                live.append((node, token))
        live.append((0, last))
        found = self.steps[state][byte] = self.intern(tuple(live)), last
        return found

    def intern(self, live: tuple) -> int:
        n = self.number.get(live)
        if n is None:
            n = self.number[live] = len(self.states)
            self.states.append(live)
            self.steps.append({})
        return n

    def path(self, lasts: list[int], end: int) -> list[int]:
        """Tokens of the prefix of that length, from the last token of each prefix."""
        out = []
        while end:
            out.append(lasts[end - 1])
            end -= self.length[lasts[end - 1]]
        return out[::-1]

    def settled(self, state: int, lasts: list[int]) -> int:
        """The newest boundary that lies on the paths of all live boundaries."""
        ends = {len(lasts) - self.depth[node] for node, _ in self.states[state]}
        while len(ends) > 1:
            newest = max(ends)
            ends.remove(newest)
            ends.add(newest - self.length[lasts[newest - 1]])
        return ends.pop()

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, lasts, out = 0, [], []
        for c in piece:
            found = self.steps[state].get(c)
            state, last = found if found is not None else self.step(state, c)
            lasts.append(last)
            if len(lasts) >= LOOKAHEAD and len(lasts) % LOOKAHEAD == 0:
                end = self.settled(state, lasts)
                out += self.path(lasts, end)
                del lasts[:end]
        return out + self.path(lasts, len(lasts))


class Utf8Machine:
    """Streaming decoder of tokens: ``feed`` returns the text that the token completes.

    The state is the incomplete sequence so far; transitions are remembered by (state, token).
    A byte that cannot continue its sequence gives U+FFFD.
    """

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of, self.moves = bytes_of, {}
        # Tokens that are whole characters: from the empty state they lead back to it.
        starts = ((i, self.move(b"", b)) for i, b in bytes_of.items())
        self.whole = {i: text for i, (text, pending) in starts if not pending}

    @staticmethod
    def allowed(pending: bytes) -> tuple[int, int, int]:
        """Range of the next byte, and bytes still missing, after an incomplete sequence."""
        lead = pending[0]
        need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        low, high = 0x80, 0xBF
        if len(pending) == 1:
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, low)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, high)
        return low, high, need - len(pending)

    def move(self, pending: bytes, data: bytes) -> tuple[str, bytes]:
        out = []
        for c in data:
            if pending:
                low, high, missing = self.allowed(pending)
                if low <= c <= high:
                    pending += bytes([c])
                    if missing == 1:
                        out.append(pending.decode())
                        pending = b""
                    continue
                out.append("�")
                pending = b""
            if c < 0x80:
                out.append(chr(c))
            elif 0xC2 <= c <= 0xF4:
                pending = bytes([c])
            else:
                out.append("�")
        return "".join(out), pending

    def feed(self, pending: bytes, ids: list[int]) -> tuple[str, bytes]:
        if not pending:
            texts = list(map(self.whole.get, ids))
            if None not in texts:
                return "".join(texts), b""
        out = []
        for i in ids:
            found = self.moves.get((pending, i))
            if found is None:
                if len(self.moves) > MAX_PIECES:
                    self.moves.clear()
                found = self.moves[pending, i] = self.move(pending, self.bytes_of[i])
            text, pending = found
            out.append(text)
        return "".join(out), pending


class Codec:
    """Text to ids by splitting pattern and transducer, and back."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.transducer = Transducer(ranks)
        self.machine = Utf8Machine(self.transducer.bytes_of)
        self.split = regex.compile(pattern)
        self.split_latin = re.compile(LATIN_PATTERN) if pattern == PATTERN else None
        self.digits = {i: str(i) for i in self.transducer.bytes_of}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one match; the last used pieces are remembered."""
        found = self.older.get(text)
        if found is None:
            found = tuple(self.transducer.encode(text.encode("utf-8", "surrogatepass")))
        if len(text) <= LONG_PIECE:
            if len(self.pieces) >= MAX_PIECES:
                self.pieces, self.older = {}, self.pieces
            self.pieces[text] = found
        return found

    def runs(self, text: str):
        """Ids of the text, in lists of at least RUN pieces' ids."""
        latin = self.split_latin is not None and (text.isascii() or not NOT_LATIN.search(text))
        split = self.split_latin if latin else self.split
        if len(text) <= 20 * RUN:
            pieces = iter(split.findall(text))
        else:
            pieces = (m.group() for m in split.finditer(text))
        while run := list(islice(pieces, RUN)):
            get, piece = self.pieces.get, self.piece
            yield list(chain.from_iterable([get(p) or piece(p) for p in run]))

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.runs(text) for i in ids]

    def decode(self, ids: list[int]) -> str:
        text, pending = self.machine.feed(b"", ids)
        return text + "�" * bool(pending)

    def digest(self, text: str) -> tuple[int, str, str, int]:
        """(tokens, sha256 of the ids, sha256 of the decoded bytes, characters decoded)."""
        n, chars, pending = 0, 0, b""
        said, back = hashlib.sha256(), hashlib.sha256()
        for ids in self.runs(text):
            joined = ",".join(map(self.digits.__getitem__, ids))
            said.update(("," + joined if n else joined).encode())
            n += len(ids)
            part, pending = self.machine.feed(pending, ids)
            back.update(part.encode())
            chars += len(part)
        if pending:
            back.update("�".encode())
        return n, said.hexdigest(), back.hexdigest(), chars + bool(pending)

    def forget(self) -> None:
        """Drop everything that is remembered of texts seen; tables of the vocabulary stay."""
        self.pieces, self.older = {}, {}
        self.transducer.agrees.clear()
        self.transducer.reset()
        self.machine.moves.clear()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN, forget: bool = False) -> DataFrame:
    """Token count and digests of ids and of the state machine's output (columns of SCHEMA) for each row of ``docs``.

    A worker keeps its codec from task to task; with ``forget`` only the vocabulary's tables, so that
    later jobs in the same workers have the memory.
    """

    def work(batches):
        c = codec(path, pattern)
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            rows = [c.digest(t.as_py() or "") for t in batch.column(1)]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))], names=names
            )

    def end():
        codec(path, pattern).forget()

    work = tidy(work, end) if forget else work
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, SCHEMA)


def token_ids(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, ids): the token ids of each row of ``docs``."""

    def work(batches):
        c = codec(path, pattern)
        for batch in batches:
            ids = [c.encode(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, "doc_id bigint, ids array<int>")


def decode_ids(encoded: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""

    def work(batches):
        c = codec(path, pattern)
        for batch in batches:
            texts = [c.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(work, "doc_id bigint, text string")


def query(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    return encode_documents(table(spark, sf_dir, "documents"))


def stage_encode(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: doc_id with token count and digests."""
    return encode_documents(docs, forget=True)
