"""Secret scans: fixed patterns, and a linear-chain conditional random field for the rest.

The field tags tokens as begin (B), inside (I) or outside (O) of a secret from
their shape, the words beside them and features of the file, and is decoded by
Viterbi. Long tokens that can be part of a secret (CANDIDATE), tokens of any
alphabet soon after a hint word, and the password's place in an address may be
tagged B or I; all others are O by constraint. A constrained chain falls apart
at its O tokens, so decoding the runs of candidates gives the best tags of whole
texts.

It is trained here, on sentences made from a seed (TRAINING of them, TRAINING_SEED), so
nothing is gathered from the corpus and every run has the same model.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: The base patterns, in the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run that is too short has no longer one in it
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")

#: Tokens that may be tagged as secret; they have both a digit and a letter.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=.~-])(?=[A-Za-z+/_=.~-]*[0-9])[A-Za-z0-9+/_=.~-]{16,}")
LETTER = re.compile(r"[A-Za-z]")
WORD = re.compile(r"[A-Za-z_]+")
#: Words that often stand before a secret.
HINTS = frozenset("key apikey api token secret password passwd pwd auth bearer authorization credential credentials private access client signature webhook conn connection pw passphrase passcode".split())
HINT = re.compile(rf"(?<![A-Za-z])(?:{'|'.join(sorted(HINTS, key=len, reverse=True))})(?![A-Za-z])", re.I)
#: Tokens of any alphabet; so many after a hint, in its line, may be tagged if they have LEAST characters.
TOKEN = re.compile(r"[^\s\"'`<>,;:=][^\s\"'`<>,;]*")
NEAR, LEAST = 3, 8
#: A hint right before a token, and the password's place between the user and the host of an address.
DIRECT = re.compile(HINT.pattern + r"[\s\"'`]*(?:(?:is|was|are|to)\b)?[\s\"'`:=]*$", re.I)
USERINFO = re.compile(r"://[^\s/:@\"'`<>]{0,64}:([^\s/@\"'`<>]{6,128})@")
USER = re.compile(r"://[^\s/:@\"'`<>]*:$")
FEATURES, TRAINING, TRAINING_SEED = 4096, 2400, 7


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def shape(token: str) -> str:
    """Runs of character classes, at most eight of them."""
    kinds = ["a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c for c in token[:64]]
    return "".join(k for i, k in enumerate(kinds) if not i or k != kinds[i - 1])[:8]


def features(token: str, before: str, after: str, follows: bool, code: bool) -> list[int]:
    """Hashed features of a candidate with up to 40 characters of text on either side."""
    counts = [sum(c.isdigit() for c in token), sum(c.islower() for c in token), sum(c.isupper() for c in token)]
    n = len(token)
    entropy = -sum(k / n * math.log2(k / n) for k in (token.count(c) for c in set(token)))
    changes = sum(a.isdigit() != b.isdigit() or a.isupper() != b.isupper() for a, b in zip(token, token[1:], strict=False)) / n
    words = [w.lower() for w in WORD.findall(before)[-3:]]
    direct, user, form = bool(DIRECT.search(before)), bool(after[:1] == "@" and USER.search(before)), shape(token)[:3]
    parts = max((len(p) for p in re.split(r"[/_.=~+-]", token)), default=0)
    names = [
        "bias", f"len{min(n, 64) // 8}", f"entropy{entropy:.0f}", f"entropy{2 * entropy:.0f}h", f"changes{int(8 * changes)}", f"shape{shape(token)}", f"head{shape(token[:6])}",
        *(f"{k}{int(4 * c / n)}" for k, c in zip("dlu", counts, strict=True)), f"part{min(parts, 40) // 5}", f"dots{min(token.count('.'), 3)}", f"slash{min(token.count('/'), 3)}",
        f"dash{min(token.count('-'), 5)}", f"pad{token.endswith('=')}", f"sep{before.rstrip()[-1:] if before.rstrip()[-1:] in '=:' else ''}", f"quote{before[-1:] in {chr(34), chr(39), '`'}}",
        f"at{after[:1] == '@' or before[-1:] == '@'}", f"url{'://' in before[-12:] or 'www' in token}", f"hint{any(p in HINTS for w in words for p in w.split('_'))}", f"code{code}", f"follows{follows}",
        *(f"w{w}" for w in words[-1:]), f"direct{direct}", f"user{user}", f"direct{direct}{form}", f"direct{direct}{form}{min(n, 32) // 4}", f"form{form}{user}", f"hex{all(c in '0123456789ABCDEF' for c in token)}{direct}",
    ]
    return [zlib.crc32(x.encode()) % FEATURES for x in names]


def near_hints(text: str) -> Iterator[tuple[int, int]]:
    """Tokens, of any alphabet, among the first after a hint word."""
    for hint in HINT.finditer(text):
        at = hint.end()
        for k, m in enumerate(TOKEN.finditer(text, at)):
            if k == NEAR or "\n" in text[at : m.start()]:
                break
            at = m.end()
            end = m.start() + len(m[0].rstrip(".-!?)]}"))
            if end - m.start() >= LEAST and m[0].lower() not in HINTS:
                yield m.start(), end


def tokens_of(text: str) -> list[list[tuple[int, int]]]:
    """Runs of candidates with only white space, quotes or a backslash between them."""
    found = []
    for m in CANDIDATE.finditer(text):
        if LETTER.search(m[0]):
            found.append((m.start(), m.start() + len(m[0].rstrip(".-")), m.end()))
    for a, b in near_hints(text):
        found.append((a, b, b))
    if "://" in text:
        found += [(m.start(1), m.end(1), m.end(1)) for m in USERINFO.finditer(text)]
    out: list[list[tuple[int, int]]] = []
    last = -10
    for start, end, after in sorted(found, key=lambda x: (x[0], -x[1])):
        if start < last:  # the longer of two that begin together, else the first
            continue
        if out and start - last <= 4 and not text[last:start].strip(" \t\r\n\"'\\"):
            out[-1].append((start, end))
        else:
            out.append([(start, end)])
        last = after
    return out


def encoded(text: str, run: list[tuple[int, int]], code: bool) -> list[list[int]]:
    return [features(text[a:b], text[max(0, a - 40) : a], text[b : b + 40], k > 0, code) for k, (a, b) in enumerate(run)]


def looks_like_code(text: str) -> bool:
    """A feature of the file: how many of its lines assign or hold braces."""
    lines = text.count("\n") + 1
    return text.count("=") + text.count("{") + text.count(";") > lines / 2


class Field:
    """Weights of a linear-chain conditional random field over B, I, O."""

    def __init__(self, emit: np.ndarray, step: np.ndarray, start: np.ndarray):
        self.emit, self.step, self.start = emit, step, start

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        return np.stack([self.emit[r].sum(0) for r in rows])

    def decode(self, rows: list[list[int]]) -> list[int]:
        """The best tags by Viterbi."""
        s = self.scores(rows)
        best, back = self.start + s[0], []
        for x in s[1:]:
            all_ = best[:, None] + self.step + x[None, :]
            back.append(all_.argmax(0))
            best = all_.max(0)
        tags = [int(best.argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        return tags[::-1]


def train(chains: list[tuple[list[list[int]], list[int]]], rounds: int = 60, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Maximum likelihood by gradient ascent (AdaGrad); gradients by forward-backward."""
    emit, step, start = np.zeros((FEATURES, 3)), np.zeros((3, 3)), np.zeros(3)
    start[1] = step[2, 1] = -1e4  # I only after B or I
    sums = [np.full_like(x, 1e-6) for x in (emit, step, start)]
    flat = np.array([f for rows, _ in chains for r in rows for f in r])
    width = np.array([len(r) for rows, _ in chains for r in rows])
    owner = np.repeat(np.arange(len(width)), width)
    longest = max(len(t) for _, t in chains)
    place = np.full((len(chains), longest), -1)
    gold = np.zeros((len(width), 3))
    gold_step, gold_start, k = np.zeros((3, 3)), np.zeros(3), 0
    for c, (_, tags) in enumerate(chains):
        gold_start[tags[0]] += 1
        for i, t in enumerate(tags):
            place[c, i], gold[k, t] = k, 1
            if i:
                gold_step[tags[i - 1], t] += 1
            k += 1
    live = place >= 0
    for _ in range(rounds):
        scores = np.zeros((len(width), 3))
        for t in range(3):
            scores[:, t] = np.bincount(owner, emit[flat, t], len(width))
        s = np.where(live[..., None], scores[place], 0)
        fore, aft = np.zeros((len(chains), longest, 3)), np.zeros((len(chains), longest, 3))
        fore[:, 0] = start + s[:, 0]
        for i in range(1, longest):
            new = np.logaddexp.reduce(fore[:, i - 1, :, None] + step, axis=1) + s[:, i]
            fore[:, i] = np.where(live[:, i, None], new, fore[:, i - 1])
        for i in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(step[None] + (s[:, i + 1] + aft[:, i + 1])[:, None, :], axis=2)
            aft[:, i] = np.where(live[:, i + 1, None], new, 0)
        total = np.logaddexp.reduce(fore[:, -1], axis=1)
        marginal = np.exp(fore + aft - total[:, None, None])
        grad_step = gold_step.copy()
        for i in range(1, longest):
            both = np.exp(fore[:, i - 1, :, None] + step + (s[:, i] + aft[:, i])[:, None, :] - total[:, None, None])
            grad_step -= both[live[:, i]].sum(0)
        error = gold - marginal[live]
        grad = np.stack([np.bincount(flat, error[owner, t], FEATURES) for t in range(3)], 1)
        for w, g, q in zip((emit, step, start), (grad - decay * emit, grad_step, gold_start - marginal[:, 0].sum(0)), sums, strict=True):
            q += g**2
            w += rate * g / np.sqrt(q)
        start[1] = step[2, 1] = -1e4
    return Field(emit, step, start)


def training_chains(count: int = TRAINING, seed: int = TRAINING_SEED) -> list[tuple[list[list[int]], list[int]]]:
    """Made sentences with secrets and with look-alikes (numbers, names, paths, hosts, versions, ids)."""
    r = Random(seed)
    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    some = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    word = lambda: some(low, r.randint(2, 9))
    b64 = low + up + dig + "+/"

    def secret() -> list[str]:
        k = r.randrange(9)
        if direct == 2:  # in an address
            return [r.choice((some(low + up + dig, r.randint(8, 16)), some(low, 4).capitalize() + some(dig, 2) + r.choice("!$%_-") + some(low + dig, 5), some(low + dig, r.randint(8, 20))))]
        if direct and r.random() < 0.4:  # weak ones, and phrases
            return [r.choice((some(low, r.randint(4, 8)) + some(dig, r.randint(1, 4)) + some(low, r.randint(0, 5)) + some(dig, 1), some(low, r.randint(4, 8)) + some(dig, r.randint(1, 2)) + some(low, r.randint(3, 6)), some(low, r.randint(20, 32))))]
        if not direct and k in (4, 6, 7, 8):  # these need their hint
            k = r.randrange(4)
        if k == 6:
            return [some(low, r.randint(3, 7)).capitalize() + some(dig, r.randint(1, 3)) + some(low + dig, r.randint(3, 6))]
        if k == 7:
            return [some(low + up + dig, r.randint(3, 6)) + r.choice("!@#$%") + some(low + up + dig, r.randint(3, 6)) + r.choice("!@#$%") + some(low + dig, r.randint(1, 4))]
        if k == 8:
            return [some(low + up, r.randint(12, 40))]
        if k == 0:
            return [some(low + up + dig, r.randint(20, 44))]
        if k == 1:
            return [some(b64, r.randint(20, 60)) + "=" * r.randrange(3)]
        if k == 2:
            return [r.choice(("sk_live_", "sk-", "ghp_", "pk_test_", "xoxb-", "glpat-", "key-")) + some(low + up + dig, r.randint(16, 40))]
        if k == 3:
            return ["ey" + some(low + up + dig, 18) + "." + some(low + up + dig, 30) + "." + some(low + up + dig + "_-", 30)]
        if k == 4:
            return [some(up + dig, r.randint(18, 32))]
        return [some(b64, 64) for _ in range(r.randint(2, 4))]

    def alike() -> list[str]:
        k = r.randrange(20)
        if direct == 2:
            return [r.choice(("password", "username", "changeme", "yourpassword", "xxxxxxxx", "********", "<password>", "{password}", "$PASSWORD", "secret"))]
        if k in (16, 17):  # numbers of orders, parts and the like, sums of files
            n = r.choice((12, 16, 16, 18, 20, 24, 32, 40, 40, 64))
            return [some("0123456789ABCDEF" if n >= 24 or r.random() < 0.4 else up + dig, n)]
        if k == 18:
            return ["".join(some(up, 4) + some(dig, 4) for _ in range(r.randint(2, 4)))]
        if k == 19:
            return ["-".join(some(up + dig, r.randint(3, 6)) for _ in range(r.randint(3, 5)))]
        if k in (10, 11, 12):
            return [some(low, r.randint(8, 16)) for _ in range(r.randint(1, 3))]
        if k == 13:
            return [some(low, r.randint(7, 14)).capitalize(), some(low, r.randint(8, 12))]
        if k == 14:
            return [r.choice((some(low, 9).upper(), some(low, 6) + "-" + some(low, 6), some(low, 8) + "()", some(low, 5) + "." + some(low, 6), some(low, 5) + some(low, 5).capitalize()))]
        if k == 15:
            return [r.choice((f"{r.randrange(1000, 3000)}-{r.randrange(10, 13)}-{r.randrange(10, 29)}", "+" + some(dig, 11), some(dig, r.randint(8, 14)), some(low, 6) + "@" + some(low, 6) + ".com"))]
        if k == 0:
            return ["/".join(word() for _ in range(r.randint(2, 4))) + f"/{r.randrange(3000)}"]
        if k == 1:
            return [".".join((word(), word(), "example", "com")) + str(r.randrange(99))]
        if k == 2:
            return ["_".join(word() for _ in range(r.randint(2, 4))) + f"_v{r.randrange(20)}"]
        if k == 3:
            return ["-".join(word() for _ in range(r.randint(2, 5))) + f"-{r.randrange(2000, 2030)}"]
        if k == 4:
            return [f"20{r.randrange(10, 30)}-{r.randrange(1, 13):02d}-{r.randrange(1, 29):02d}T{r.randrange(24):02d}.{r.randrange(60):02d}.{r.randrange(60):02d}Z"]
        if k == 5:
            return [some(low, r.randint(12, 24)) + str(r.randrange(100))]
        if k == 6:
            return [word() + "." + word() + str(r.randrange(100)) + "." + word() + "." + word() + ".org"]
        if k == 7:
            return [f"DE{some(dig, 18)}" if r.random() < 0.5 else f"ISBN-{some(dig, 13)}"]
        if k == 8:
            return [some(low, 5).capitalize() + some(low, 6).capitalize() + some(low, 6).capitalize() + str(r.randrange(10))]
        return ["=".join(("page", word())) + "." + word() + f"{r.randrange(99)}={word()}"]

    chains = []
    for _ in range(count):
        good = r.random() < 0.5
        hint = r.choice(sorted(HINTS)) if r.random() < (0.75 if good else 0.5) else word()
        prose = f"{r.choice(('order', 'commit', 'checksum', 'invoice', 'serial', 'part', 'ref', 'sum', word(), word()))} "
        direct = int(hint in HINTS)
        if r.random() < 0.08:
            direct, lead = 2, f"{r.choice(('jdbc:postgres', 'mysql', 'https', 'amqp', 'redis', 'ftp', word()))}://{word()}:"
        elif r.random() < 0.8:
            lead = r.choice((f"{hint} = \"", f"{hint}: ", f"{hint} is ", f"{hint} was ", f"{word()} {hint} ", f"{word()}_{hint}='", f"{hint}="))
        else:
            direct, lead = 0, f"{word()} {prose}"
        parts = secret() if good else alike()
        if not good and direct == 1 and any(c.isdigit() for p in parts for c in p):  # what looks like one right after its hint is one
            lead = r.choice((f"{hint} {word()} ", f"{hint} for {prose}", f"{word()} {prose}"))
        text = " ".join(word() for _ in range(r.randint(2, 8))) + " " + lead
        text += ("\n" if len(parts) > 1 else " ").join(parts) + (f"@{word()}.{word()}/{word()} " if direct == 2 else r.choice((" ", "\" ", "' ", ". ", "\n"))) + word()
        for run in tokens_of(text):
            inside = [any(text[a:b].rstrip(".-") in p or p in text[a:b] for p in parts) and good for a, b in run]
            tags = [0 if x and (not i or not inside[i - 1]) else 1 if x else 2 for i, x in enumerate(inside)]
            chains.append((encoded(text, run, looks_like_code(text)), tags))
    return chains


_field: list[Field] = []


def field() -> Field:
    """Trained once in each process."""
    if not _field:
        _field.append(train(training_chains()))
    return _field[0]


class Covers:
    """Whether one of some spans covers a stretch, by halving: of those that begin before it, how far the farthest reaches."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = [s for s, _, _ in spans]  # spans come sorted
        self.reach = list(accumulate((e for _, _, e in spans), max))

    def __call__(self, start: int, end: int) -> bool:
        k = bisect_right(self.starts, start)
        return k > 0 and self.reach[k - 1] >= end


def crf_spans(text: str, model: Field, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans tagged by the field, but for those that one base span covers."""
    out, code, covered = [], None, Covers(base)
    for run in tokens_of(text):
        if all(covered(a, b) for a, b in run):
            continue
        if code is None:
            code = looks_like_code(text)
        tags = model.decode(encoded(text, run, code))
        for k, ((a, b), t) in enumerate(zip(run, tags, strict=True)):
            if t == 0:
                out.append((a, 3, b))
            elif t == 1 and k:
                out[-1] = (out[-1][0], 3, b)
    return [(a, k, b) for a, k, b in out if not covered(a, b)]


def spans_of(text: str, model: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each by start, then kind."""
    base = base_spans(text)
    return base, sorted(base + crf_spans(text, model, base))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "<SECRET>") -> str:
    """The text with each stretch covered by spans replaced by the mark."""
    out, at = [], 0
    for a, _, b in sorted(spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def _pack(weights: Field) -> bytes:
    return zlib.compress(b"".join(x.astype("<f8").tobytes() for x in (weights.emit, weights.step, weights.start)))


def _unpack(blob: bytes) -> Field:
    x = np.frombuffer(zlib.decompress(blob), "<f8")
    n = FEATURES * 3
    return Field(x[:n].reshape(FEATURES, 3), x[n : n + 9].reshape(3, 3), x[n + 9 :])


def _scan(blob: bytes, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _unpack(blob)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                base, all_ = spans_of(text, model)
                kinds = [k for _, k, _ in base]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*(kinds.count(k) for k in range(3)), digest, written(all_), *((redact(text, all_) if all_ else text,) if keep_text else ())))
            kinds_ = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "redacted"]
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds_, strict=False)] if rows else [pa.array([], k) for k in kinds_[: 5 + keep_text]]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, *range(2, batch.num_columns))), *columns], names=[*(batch.schema.names[i] for i in (0, *range(2, batch.num_columns))), *names[: len(columns)]])

    return run


def scan(docs: DataFrame, *, keep: list[str] | None = None, redacted: bool = False) -> DataFrame:
    """Per row of docs (doc_id, text): numbers of base spans, their digest, and all spans as kind:start:end.

    Offsets are code points, ends exclusive. A null text counts as empty;
    repeated rows give repeated results, no rows none. `keep`: other columns to carry along;
    `redacted`: also the text with its secrets replaced. The rest is left out;
    a column to keep that has a result's name is an error.
    """
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", *["redacted"] * redacted]
    if clash := {"doc_id", "text", *names} & set(keep or []):
        raise ValueError(f"columns to keep have the names of results: {sorted(clash)}")
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), *[F.col(c) for c in keep or []])
    made = [StructField(n, LongType() if n.startswith("n_") else StringType()) for n in names]
    schema = StructType([docs.schema["doc_id"], *(docs.schema[c] for c in keep or []), *made])
    return docs.mapInArrow(_scan(_pack(field()), redacted), schema)
