"""Byte-level BPE encoding and decoding by recursive DuckDB queries in each partition.

A partition's new words become rows (word, position, token). A recursive query
joins neighbouring tokens with the merge table and contracts each word's
leftmost pair of minimum rank until no pair is left. Long words are cut before,
where no token of the vocabulary that occurs in them goes across: no merge can.
In what is still long all pairs of the least rank are contracted at once, up to
the first whose token makes a pair of a lower rank yet, with the same result in
fewer rounds; a part of WHOLE bytes or more takes the same rounds over arrays, since a
query over it would outgrow its memory. Ordered aggregation gives a word's tokens; documents are put together
from their words in order.

Decoding joins the rows (document, position, token) of whole documents with the
tokens' bytes, and an ordered aggregation puts them together.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that a worker remembers; beyond it those not seen lately are forgotten. It affects no result.
REMEMBERED = 1_600_000
#: Words in one recursive query, the length in bytes from which words are cut and pairs in runs contracted by turns, and
#: bytes of these in one query.
WORDS, LONG, BYTES = 16_000, 48, 20_000
#: Bytes from which a word's part, that no cut divides, is contracted in arrays: the windows of a query over it would take
#: some 250 bytes of memory a byte, and must not spill.
WHOLE = 200_000
#: Tokens decoded in one query; a longer document takes several.
TOKENS = 1_000_000
NO_PAIR = np.iinfo(np.int32).max
OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: Short words: a round unfolds each word to rows (word, position), joins neighbours with the merge table, and contracts
#: the word's least (rank, position); a word without any isn't looked at again.
SHORT = """
WITH RECURSIVE t(w, ids) USING KEY (w) AS (
  SELECT w, ids FROM base
  UNION
  SELECT t.w, list_concat(ids[:spot - 1], [best::INTEGER], ids[spot + 2:])
  FROM t JOIN (
    SELECT p.w, min((m.id::BIGINT << 40) | p.pos) >> 40 AS best, min((m.id::BIGINT << 40) | p.pos) & 1099511627775 AS spot
    FROM (SELECT w, unnest(ids[:-2]) AS l, unnest(ids[2:]) AS r, unnest(range(1, len(ids))) AS pos FROM t) p
    JOIN merges m ON m.l = p.l AND m.r = p.r
    GROUP BY p.w
  ) b ON b.w = t.w
) SELECT w, ids FROM t"""
#: Long words, as rows from the start: a round contracts all pairs of the least rank, but of those that overlap in a run
#: every second, and none behind the first whose token makes a pair of lower rank with a neighbour.
RUNS = """
WITH RECURSIVE t(w, pos, id, open) AS (
  SELECT w, pos, id, true FROM base
  UNION ALL
  SELECT w, pos, CASE WHEN picked THEN least ELSE id END, least IS NOT NULL
  FROM (
    SELECT *, lag(picked) OVER (PARTITION BY w ORDER BY pos) AS taken
    FROM (
      SELECT w, pos, id, least, coalesce(hit AND rn <= min(CASE WHEN undercut THEN rn ELSE 9223372036854775807 END) OVER (PARTITION BY w)
        AND (rn - max(CASE WHEN hit AND NOT coalesce(prior, false) THEN rn END) OVER (PARTITION BY w ORDER BY pos ROWS UNBOUNDED PRECEDING)) % 2 = 0, false) AS picked
      FROM (
        SELECT p.*, lag(hit) OVER (PARTITION BY p.w ORDER BY p.pos) AS prior, coalesce(a.id < p.least OR b.id < p.least OR c.id < p.least, false) AS undercut
        FROM (
          SELECT n.*, m.id AS rank, min(m.id) OVER (PARTITION BY n.w) AS least, coalesce(m.id = min(m.id) OVER (PARTITION BY n.w), false) AS hit
          FROM (
            SELECT w, pos, id, lag(id) OVER s AS before, lead(id) OVER s AS nxt, lead(id, 2) OVER s AS behind, row_number() OVER s AS rn FROM t WHERE open WINDOW s AS (PARTITION BY w ORDER BY pos)
          ) n LEFT JOIN merges m ON m.l = n.id AND m.r = n.nxt
        ) p
        LEFT JOIN merges a ON p.hit AND a.l = p.before AND a.r = p.least
        LEFT JOIN merges b ON p.hit AND b.l = p.least AND b.r = p.behind
        LEFT JOIN merges c ON p.hit AND c.l = p.least AND c.r = p.least
      )
    )
  ) WHERE NOT coalesce(taken, false)
) SELECT w, list(id ORDER BY pos) AS ids FROM t WHERE NOT open GROUP BY w"""
#: Rows (document, position, token) to the bytes of each document.
DECODE = "SELECT doc, list(bytes ORDER BY pos) AS parts FROM rows JOIN tokens USING (id) GROUP BY doc ORDER BY doc"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """(l, r, id): every split of a token into two."""
    merges = [(ranks[t[:k]], ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    left, right, ids = zip(*merges, strict=True) if merges else ((), (), ())
    kind = pa.int32()
    return pa.table({"l": pa.array(left, kind), "r": pa.array(right, kind), "id": pa.array(ids, kind)})


class Pairs:
    """The merge table as sorted keys, for whole arrays of pairs."""

    def __init__(self, merges: pa.Table):
        left, right, ids = (merges.column(c).to_numpy().astype(np.int64) for c in ("l", "r", "id"))
        order = np.argsort((left << 32) | right)
        self.keys, self.ids = ((left << 32) | right)[order], ids[order].astype(np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token of each pair, NO_PAIR if it has none. Taken in blocks, so that little beside the result is held."""
        out = np.full(len(left), NO_PAIR, np.int32)
        for k in range(0, len(left) if len(self.keys) else 0, 2**18):
            key = (left[k : k + 2**18].astype(np.int64) << 32) | right[k : k + 2**18]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[k : k + 2**18] = np.where(self.keys[at] == key, self.ids[at], NO_PAIR)
        return out

    def contract(self, ids: np.ndarray) -> np.ndarray:
        """The tokens of one long word by the rounds of RUNS: all pairs of the least rank, up to the first that makes a lower one."""
        while len(ids) > 1:
            rank = self.ranks(ids[:-1], ids[1:])
            least = rank.min()
            if least == NO_PAIR:
                break
            at = np.flatnonzero(rank == least)
            del rank
            token = np.full(len(at), least, np.int32)
            before = np.where(at > 0, self.ranks(ids[np.maximum(at - 1, 0)], token), NO_PAIR)
            behind = np.where(at + 2 < len(ids), self.ranks(token, ids[np.minimum(at + 2, len(ids) - 1)]), NO_PAIR)
            undercut = (before < least) | (behind < least) | (self.ranks(token, token) < least)
            if undercut.any():
                at = at[: int(np.argmax(undercut)) + 1]
            first = np.ones(len(at), bool)  # of pairs that overlap, in a run, every second is contracted
            first[1:] = at[1:] != at[:-1] + 1
            at = at[(at - np.maximum.accumulate(np.where(first, at, 0))) % 2 == 0]
            ids = ids.copy()
            ids[at] = least
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids = ids[stay]
        return ids


class Bpe:
    """Encoder and decoder of one rank file, in one process. Its database is in memory and never spills to disk."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.ranks = load_ranks(path)
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.find = regex.compile(pattern).findall
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        merges = merge_table(self.ranks)
        self.pairs = Pairs(merges)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges")
        named = pa.table({"id": pa.array(list(self.ranks.values()), pa.int32()), "bytes": pa.array(list(self.ranks), pa.binary())})  # noqa: F841  read by name
        self.db.execute("CREATE TABLE tokens AS SELECT * FROM named")
        self.known: tuple[dict[str, str], dict[str, bytes]] = {}, {}  # a word's ids as text, and as 32-bit numbers
        self.older: tuple[dict[str, str], dict[str, bytes]] = {}, {}
        self.matcher = None

    def cut(self, word: bytes) -> list[bytes]:
        """The word's parts between places that no token that occurs in it goes across."""
        if self.matcher is None:
            import ahocorasick

            self.matcher = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for t in self.ranks:
                if len(t) > 1:
                    self.matcher.add_word(t.decode("latin-1"), len(t))
            self.matcher.make_automaton()
        # +1 where a token is entered, -1 where it ends; places above 0 are inside of one
        change = np.zeros(len(word) + 1, np.int32)
        for last, size in self.matcher.iter(word.decode("latin-1")):
            change[last - size + 2] += 1
            change[last + 1] -= 1
        at = [0, *(np.flatnonzero(np.cumsum(change)[1 : len(word)] == 0) + 1).tolist(), len(word)]
        return [word[i:j] for i, j in zip(at, at[1:], strict=False)]

    def contract(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word, by the recursive queries."""
        parts = [self.cut(w) if len(w) > LONG else [w] for w in words]
        number = {x: k for k, x in enumerate(dict.fromkeys(x for w in parts for x in w))}
        distinct = list(number)
        sizes = np.array([len(x) for x in distinct])
        out: list[list[int]] = [[] for _ in distinct]
        for i in np.flatnonzero(sizes >= WHOLE):
            out[i] = self.pairs.contract(self.bytes[np.frombuffer(distinct[i], np.uint8)]).tolist()
        for runs in (False, True):
            which = np.flatnonzero(((sizes > LONG) == runs) & (sizes < WHOLE))
            if runs:
                turn = np.cumsum(sizes[which]) // BYTES
                batches = [which[turn == t] for t in np.unique(turn)]
            else:
                batches = [which[k : k + WORDS] for k in range(0, len(which), WORDS)]
            for part in batches:
                n = sizes[part]
                raw = np.frombuffer(b"".join(distinct[i] for i in part), np.uint8)
                if runs:  # as rows (word, position, token), short words as lists of tokens; read by name in the queries
                    base = pa.table({"w": np.repeat(part, n), "pos": np.arange(len(raw)) - np.repeat(np.cumsum(n) - n, n), "id": self.bytes[raw]})
                else:
                    edges = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    base = pa.table({"w": part, "ids": pa.ListArray.from_arrays(pa.array(edges), pa.array(self.bytes[raw]))})  # noqa: F841
                found = self.db.sql(RUNS if runs else SHORT).to_arrow_table() if len(raw) else None
                if found is not None:
                    for w, ids in zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True):
                        out[w] = ids
        return [out[number[w[0]]] if len(w) == 1 else [i for x in w for i in out[number[x]]] for w in parts]

    def learn(self, words: set[str]) -> None:
        """Remembers the words' ids, as text and as 32-bit numbers."""
        if len(self.known[0]) + len(words) > REMEMBERED // 2:
            self.known, self.older = ({}, {}), self.known
        (text, raw), (old_text, old_raw) = self.known, self.older
        todo = []
        for w in words - text.keys():
            if w in old_text:
                text[w], raw[w] = old_text[w], old_raw[w]
                continue
            i = self.ranks.get(w.encode())
            if i is None:
                todo.append(w)
            else:
                text[w], raw[w] = str(i), i.to_bytes(4, "little")
        for w, ids in zip(todo, self.contract([w.encode() for w in todo]), strict=True):
            text[w], raw[w] = ",".join(map(str, ids)), np.array(ids, "<i4").tobytes()

    def encoded(self, words: list[str]) -> np.ndarray:
        """Ids of a document from its words, which have been learnt."""
        return np.frombuffer(b"".join(map(self.known[1].__getitem__, words)), "<i4")

    def encode(self, text: str) -> list[int]:
        words = self.find(text)
        self.learn(set(words))
        return self.encoded(words).tolist()

    def decoded(self, documents: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
        """(number of the document, bytes) of the documents' ids, in order; a long document comes in pieces."""
        ids = np.concatenate(documents) if documents else np.zeros(0, np.int32)
        doc = np.repeat(np.arange(len(documents), dtype=np.int32), [len(x) for x in documents])
        for k in range(0, len(ids), TOKENS):
            part = ids[k : k + TOKENS]
            rows = pa.table({"doc": doc[k : k + TOKENS], "pos": np.arange(len(part), dtype=np.int32), "id": part})  # noqa: F841  read by name
            found = self.db.sql(DECODE).to_arrow_table().combine_chunks()
            parts = found.column("parts").combine_chunks() if isinstance(found.column("parts"), pa.ChunkedArray) else found.column("parts")
            parts = parts.chunk(0) if isinstance(parts, pa.ChunkedArray) else parts
            values = parts.values  # the bytes of all parts, one after the other
            places = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset)
            raw, edges = memoryview(values.buffers()[2]), places[parts.offsets.to_numpy()]
            for i, d in enumerate(found.column("doc").to_pylist()):
                yield d, bytes(raw[edges[i] : edges[i + 1]])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(x for _, x in self.decoded([np.array(ids, np.int32)]))

    def digests(self, documents: list[list[str]]) -> list[tuple[int, str, str]]:
        """Of documents as words: number of ids, sha-256 of the ids, and of the bytes that these are decoded to."""
        self.learn(set().union(*documents))
        ids = [self.encoded(words) for words in documents]
        hashes = [hashlib.sha256() for _ in ids]
        for d, piece in self.decoded(ids):
            hashes[d].update(piece)
        text = self.known[0].__getitem__
        return [(len(i), hashlib.sha256(",".join(map(text, words)).encode()).hexdigest(), h.hexdigest()) for i, words, h in zip(ids, documents, hashes, strict=True)]


_open: dict[tuple[str, str], Bpe] = {}


def bpe(path: str, pattern: str) -> Bpe:
    """One per worker process; workers are reused by later tasks."""
    if (path, pattern) not in _open:
        _open[path, pattern] = Bpe(path, pattern)
    return _open[path, pattern]


def _digests(path: str, pattern: str, chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path, pattern)

        def flush(ids: list, texts: list[list[str]]) -> pa.RecordBatch:
            n, a, b = zip(*model.digests(texts), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                ids.append(doc_id)
                texts.append(model.find(text))
                size += len(text)
                if size > chars:
                    yield flush(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield flush(ids, texts)

    return run


def digests(docs: DataFrame, *, ranks: str, pattern: str, chars: int = 4_000_000) -> DataFrame:
    """Per row of docs: doc_id, n_tokens and the sha-256 of its ids and of the decoded bytes.

    A null text counts as empty; repeated rows give repeated results; other
    columns are left out. `chars`: characters looked at together, to bound memory.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_digests(ranks, pattern, chars), OUT)


def _encoded(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path, pattern)
        for batch in batches:
            model.learn(set().union(*(model.find(t.as_py() or "") for t in batch.column(1))))
            ids = [model.encode(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def encode(docs: DataFrame, *, ranks: str, pattern: str) -> DataFrame:
    """docs (doc_id, text) as doc_id and ids; a null text has no ids."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_encoded(ranks, pattern), "doc_id long, ids array<int>")


def _decoded(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path, pattern)
        for batch in batches:
            raw = [b""] * batch.num_rows
            for d, piece in model.decoded([np.array([] if x is None else x, np.int32) for x in batch.column(1).to_pylist()]):
                raw[d] += piece
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "bytes"])

    return run


def decode(tokens: DataFrame, *, ranks: str, pattern: str) -> DataFrame:
    """tokens (doc_id, ids) as doc_id and the bytes they stand for."""
    return tokens.select("doc_id", "ids").mapInArrow(_decoded(ranks, pattern), "doc_id long, bytes binary")
