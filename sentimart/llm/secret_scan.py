"""Secret scan: fixed base patterns, and formats learned by grammar inference.

Base patterns find assignments, access keys and long hexadecimal strings. The
values they find are labelled credentials. From a bounded sample of each kind
a probabilistic automaton is inferred: a prefix tree of the values whose
states are merged where their symbol and end frequencies are statistically
compatible (Hoeffding bounds, states in breadth-first order). More
automata are inferred from runs that no base pattern covers: plain numbers,
words in capitals, and as ordinary text those runs only that different texts
share, counted over all documents. Unlabelled credentials are nearly all
distinct, so they do not train the automaton that would then spare them,
however many they are. (If no run is shared, runs without digits.) Then every
candidate, a run of LEAST_RUN or more credential characters outside the base
spans (of a run that touches one, each piece beside it), is scored by
format likelihood: the log-likelihood under the best credential automaton less
the one under the best of the automata for what is no credential: ordinary
text, words in capitals and plain numbers. Those above the threshold are spans of the kind
``grammar``; base spans always stay.

Texts are read once: base spans and candidates are written, labelled samples
(of bounded size, by hash, see ``SAMPLE``) go to the driver, and the automata
(bounded by the samples) go back with the scoring task.

Defined results: a null text is empty; an empty text has no span; without
labelled credentials of a kind its automaton is left out; repeated rows give
equal results; a null doc_id is kept; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentimart.llm.common import text_of, written

# The base patterns, their kinds in order, and their least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # greedy from the start of a run: the runs of 24 or more
LEAST_VALUE, LEAST_ACCESS = 6, 20

GRAMMAR = "grammar"
SHORT = re.compile(r"[A-Za-z0-9+/_.=-]+")
#: A candidate's least length, and the least log-likelihood ratio (nats) of a grammar span.
LEAST_RUN, THRESHOLD = 12, 12.0
RUN = re.compile(SHORT.pattern[:-1] + "{%d,}" % LEAST_RUN)
#: Labelled credentials of each kind, and ordinary runs, that automata are inferred from.
SAMPLE = {"assign": 300, "access": 300, "hex": 300, "text": 3000, "capitals": 1000, "number": 300}
#: Runs shorter than LEAST_RUN train the automaton of ordinary text and are no candidates (every other word is one);
#: one in so many documents, by hash, offers them.
ONE_IN = 16
ALPHA = 0.05


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, in order; code points, end exclusive."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def free_runs(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """``(start, stop)`` of the candidates: runs without the base spans, in one walk along both."""
    out, i, covered = [], 0, []
    for a, _, b in spans:  # sorted by start: disjoint stretches
        if covered and a < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    for m in RUN.finditer(text):
        at = m.start()
        while i < len(covered) and covered[i][1] <= at:
            i += 1
        while i < len(covered) and covered[i][0] < m.end():
            out.append((at, covered[i][0]))
            at = covered[i][1]
            if at >= m.end():
                break
            i += 1
        out.append((at, m.end()))
    return [(a, b) for a, b in out if b - a >= LEAST_RUN]


class Automaton:
    """A probabilistic automaton inferred from strings by state merging."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.seen, self.ends, self.next, self.count = [0], [0], [{}], [{}]
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        for s in strings:
            q = 0
            for c in s:
                self.seen[q] += 1
                self.count[q][c] = self.count[q].get(c, 0) + 1
                if c not in self.next[q]:
                    self.next[q][c] = len(self.seen)
                    for column, new in ((self.seen, 0), (self.ends, 0), (self.next, {}), (self.count, {})):
                        column.append(new)
                q = self.next[q][c]
            self.seen[q] += 1
            self.ends[q] += 1
        self._merge_states()
        self.tables = {q: self._table(q) for q in self.kept}

    def _merge_states(self) -> None:
        self.kept, self.todo = {0: None}, [0]
        while self.todo:
            q = self.todo.pop(0)
            for c in sorted(self.next[q]):
                child = self.next[q][c]
                if child in self.kept:
                    continue
                for r in self.kept:
                    if self._alike(r, child):
                        self.next[q][c] = r
                        self._fold(r, child)
                        break
                else:
                    self.kept[child] = None
                    self.todo.append(child)

    def _differ(self, n: int, of: int, m: int, by: int) -> bool:
        return abs(n / of - m / by) > self.bound * (of ** -0.5 + by ** -0.5)

    def _alike(self, r: int, q: int) -> bool:
        todo = [(r, q)]
        while todo:
            r, q = todo.pop()
            n, m = self.seen[r], self.seen[q]
            if self._differ(self.ends[r], n, self.ends[q], m):
                return False
            for c in self.count[r].keys() | self.count[q].keys():
                if self._differ(self.count[r].get(c, 0), n, self.count[q].get(c, 0), m):
                    return False
            todo += [(self.next[r][c], t) for c, t in self.next[q].items() if c in self.next[r]]
        return True

    def _fold(self, r: int, q: int) -> None:
        todo = [(r, q)]
        while todo:
            r, q = todo.pop()
            self.seen[r] += self.seen[q]
            self.ends[r] += self.ends[q]
            for c, n in self.count[q].items():
                self.count[r][c] = self.count[r].get(c, 0) + n
            for c, t in self.next[q].items():
                if c in self.next[r]:
                    todo.append((self.next[r][c], t))
                else:
                    self.next[r][c] = t
                    if r in self.kept:
                        self.todo.append(r)

    def _table(self, q: int) -> tuple[dict, dict, float, float, int]:
        """Log-probabilities and next states: by symbol, by class of symbols, else; and of the end."""
        total = self.seen[q] + 2.0
        by_class, to = defaultdict(int), {}
        for c, n in self.count[q].items():
            by_class[_class(c)] += n
        for c in sorted(self.next[q], key=lambda c: self.count[q][c]):
            to[_class(c)] = self.next[q][c]
        backed = {k: (n + 0.1) / total / _SIZE[k] for k, n in by_class.items()}
        symbols = {c: (math.log(0.9 * n / total + 0.1 * backed[_class(c)]), self.next[q][c]) for c, n in self.count[q].items()}
        classes = {k: (math.log(0.1 * p), to[k]) for k, p in backed.items()}
        return symbols, classes, math.log(0.1 / total / 66), math.log((self.ends[q] + 0.5) / total), q

    def score(self, s: str) -> float:
        """The log-likelihood of ``s``."""
        total, table = 0.0, self.tables[0]
        for c in s:
            found = table[0].get(c) or table[1].get(_class(c)) or (table[2], table[4])
            total += found[0]
            table = self.tables[found[1]]
        return total + table[3]


def _class(c: str) -> str:
    return "9" if c.isdigit() else "f" if "a" <= c <= "f" else "z" if c.islower() else "Z" if c.isupper() else c


_SIZE = defaultdict(lambda: 1, {"9": 10, "f": 6, "z": 20, "Z": 26})


def scanned(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, base, labelled, runs)``: base spans, labelled values by kind, candidates and text samples.

    Written once; texts are not needed after it.
    """
    @F.pandas_udf("base array<struct<start:int,kind:int,stop:int>>, labelled array<struct<kind:string,value:string>>, "
                  "runs array<struct<start:int,value:string>>")
    def scan(texts: pd.Series) -> pd.DataFrame:
        base, labelled, runs = [], [], []
        for text in texts:
            spans = base_spans(text)
            values = {("assign", ASSIGN.match(text, a)[2]) if k == 0 else (KINDS[k], text[a:b]) for a, k, b in spans}
            free = [(a, text[a:b]) for a, b in free_runs(text, spans)]
            values |= {(_plain(v), v) for _, v in free}
            if zlib.crc32(text.encode()) % ONE_IN == 0:
                values |= {("text", w) for w in SHORT.findall(text) if len(w) < LEAST_RUN}
            base.append([{"start": a, "kind": k, "stop": b} for a, k, b in spans])
            labelled.append([{"kind": k, "value": v} for k, v in sorted(values)])
            runs.append([{"start": a, "value": v} for a, v in free])
        return pd.DataFrame({"base": base, "labelled": labelled, "runs": runs})

    return written(docs.select("doc_id", F.xxhash64(text_of("text")).alias("text_hash"), scan(text_of("text")).alias("x")).select("doc_id", "text_hash", "x.*"))


def _plain(run: str) -> str:
    letters = not any(c.isdigit() for c in run)
    return "number" if run.isdigit() else "capitals" if letters and run.isupper() else "text"


def learned(found: DataFrame, sample: dict[str, int] = SAMPLE, alpha: float = ALPHA) -> dict[str, Automaton]:
    """Automata by kind, from the labelled values (of each kind those first by hash).

    Copies of a text count once: a value is shared if texts of different hashes have it.
    """
    values = found.select("text_hash", F.explode("labelled").alias("x")).groupBy("x.kind", "x.value").agg(
        (F.min("text_hash") < F.max("text_hash")).alias("shared"))
    out = {}
    for kind, most in sample.items():
        own = values.where(F.col("kind") == kind)
        for known in ("shared", "NOT value RLIKE '[0-9]'") if kind == "text" else ("true",):
            if rows := own.where(known).orderBy(F.xxhash64("value"), "value").limit(most).collect():
                break
        if rows:
            out[kind] = Automaton([r.value for r in rows], alpha)
    return out


def secrets(docs: DataFrame, threshold: float = THRESHOLD, sample: dict[str, int] = SAMPLE) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_grammar)`` of ``docs(doc_id, text)``."""
    found = scanned(docs)
    automata = learned(found, sample)
    plain, formats = ([a for k, a in automata.items() if (k in KINDS) == of] for of in (False, True))

    def likely(run: str) -> bool:
        return bool(plain and formats) and max(a.score(run) for a in formats) - max(a.score(run) for a in plain) >= threshold

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_grammar long")
    def score(base: pd.Series, runs: pd.Series) -> pd.DataFrame:
        rows = []
        for known, free in zip(base, runs, strict=True):
            spans = [(x["start"], x["kind"], x["stop"]) for x in known]
            more = [(x["start"], len(KINDS), x["start"] + len(x["value"])) for x in free if likely(x["value"])]
            n = [sum(k == i for _, k, _ in spans) for i in range(len(KINDS))]
            rows.append((*n, hashlib.sha256(_joined(spans).encode()).hexdigest(), _joined(sorted(spans + more)), len(more)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_grammar"])

    return found.select("doc_id", score("base", "runs").alias("x")).select("doc_id", "x.*")


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(*KINDS, GRAMMAR)[k]}:{a}:{b}" for a, k, b in spans)
