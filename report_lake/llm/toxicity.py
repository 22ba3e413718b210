"""Toxicity by a weighted finite-state pattern grammar.

Small transducers are run as a cascade over the tokens of one clause, each
reading what the one before it wrote:

1. the *lexical* transducer maps tokens to classes: insult (with a weight),
   threat verb, target, subject, modal, negation, reporting verb, quotation;
2. the *threat* transducer rewrites subject + modal + threat verb + target;
3. the *target* transducer marks insults that share a clause with a target;
4. the *negation* transducer marks what stands shortly after a negation;
5. the *reported-speech* transducer marks what follows a reporting verb or
   stands inside quotation marks.

Not isolated words but matched clauses are scored: each clause adds one to the
count of its context (plain, targeted, threat, negated, reported), weighted by
its insult arc, and a logistic over the five sums gives the document's score.

The insult arcs (words and word stems) and the context weights are learned from
labelled rows, from a sample with documented bounds (``max_toxic``,
``max_clean`` rows, taken in hash order). Stems matter for languages that
inflect: an arc may be a prefix that several word forms share. Frequent pure
arcs are taken as they are; rarer ones by a greedy cover of what is left of the
toxic sample, so that chance words gain nothing.

Stems that ordinary words share are no proof by themselves, but many of them in
little text are: such *dense* arcs count once a text holds two or more of them,
and at least one in ``SPARSE`` words.

Null and empty texts match no clause and get the score of a text without
matches. No labelled row: only the seed lexicon is used. Extra columns are
carried through; ``score`` and ``predicted`` are added under the names given.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stage

# Seed words of the classes (lower case; en, de, fr, es).
SEED_INSULT = "idiot moron imbecile scumbag dumbass bastard arschloch vollidiot connard abruti gilipollas cabrón"
THREAT = "kill hurt destroy murder beat stab shoot strangle umbringen töten verprügeln tuer frapper massacrer matar golpear"
TARGET = "you your yours you're u he she they him her them this these those dich dir euch du ihr vous toi tu te ti usted ustedes"
SUBJECT = "i i'll we we'll ich wir je nous yo nosotros"
MODAL = "will shall gonna going want werde werden vais allons voy vamos"
NEGATION = "not no never isn't aren't wasn't don't nor neither nicht kein keine nie pas jamais aucun nunca jamás tampoco"
REPORT = "said says wrote writes claimed called calls quoted reported sagte schrieb nannte dit écrit dijo escribió llamó"

WORD = re.compile(r"[^\W_]+(?:['’][^\W\d_]+)*|[\"“”„«»]", re.UNICODE)
CLAUSE_END = ".!?;\n"
CONTEXTS = ("plain", "targeted", "threat", "negated", "reported", "dense")
PRIOR = {"bias": -4.0, "plain": 6.0, "targeted": 7.0, "threat": 6.0, "negated": 2.0, "reported": 2.0, "dense": 6.0}
SPARSE = 200


class Transducer:
    """A deterministic transducer over class symbols.

    ``arcs[state][symbol] = (next state, function of the output so far)``;
    a symbol without an arc takes the state's ``"*"`` arc. The output is a list
    of (symbol, weight, marks) that the actions edit in place.
    """

    def __init__(self, start: str, arcs: dict):
        self.start, self.arcs = start, arcs

    def __call__(self, tape: list) -> list:
        state, out = self.start, []
        for item in tape:
            table = self.arcs[state]
            state, action = table.get(item[0]) or table["*"]
            out.append(item)
            if action:
                action(out)
        return out


def _mark(name):
    def action(out):
        s, w, m = out[-1]
        out[-1] = (s, w, m | {name})

    return action


THREATS = Transducer(
    "0",
    {
        "0": {"SUB": ("s", None), "*": ("0", None)},
        "s": {"MOD": ("m", None), "SUB": ("s", None), "NEG": ("s", None), "*": ("0", None)},
        "m": {"THR": ("v", None), "NEG": ("m", None), "OTH": ("n", None), "*": ("0", None)},
        "n": {"THR": ("v", None), "*": ("0", None)},
        "v": {"TGT": ("0", _mark("threat")), "OTH": ("w", None), "*": ("0", None)},
        "w": {"TGT": ("0", _mark("threat")), "*": ("0", None)},
    },
)
TARGETS = Transducer(
    "0",
    {
        "0": {"TGT": ("t", None), "*": ("0", None)},
        "t": {"INS": ("t", _mark("targeted")), "*": ("t", None)},
    },
)
#: A negation reaches the two tokens after it.
NEGATIONS = Transducer(
    "0",
    {
        "0": {"NEG": ("1", None), "*": ("0", None)},
        "1": {"NEG": ("1", None), "INS": ("2", _mark("negated")), "TGT": ("2", _mark("negated")), "*": ("2", None)},
        "2": {"NEG": ("1", None), "INS": ("0", _mark("negated")), "TGT": ("0", _mark("negated")), "*": ("0", None)},
    },
)
REPORTS = Transducer(
    "0",
    {
        "0": {"REP": ("r", None), "QUO": ("q", None), "*": ("0", None)},
        "r": {"INS": ("r", _mark("reported")), "TGT": ("r", _mark("reported")), "*": ("r", None)},
        "q": {"QUO": ("0", None), "INS": ("q", _mark("reported")), "TGT": ("q", _mark("reported")), "*": ("q", None)},
    },
)
CASCADE = (THREATS, TARGETS, NEGATIONS, REPORTS)


@dataclass
class Grammar:
    """Insult arcs (words and stems with weights) and context weights."""

    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(SEED_INSULT.split(), 1.0))
    stems: dict[str, float] = field(default_factory=dict)
    dense: tuple[str, ...] = ()  # words, and stems with a trailing *
    weights: dict[str, float] = field(default_factory=lambda: dict(PRIOR))

    def __post_init__(self):
        self.classes = {}
        for name, words in (("THR", THREAT), ("TGT", TARGET), ("SUB", SUBJECT), ("MOD", MODAL), ("NEG", NEGATION), ("REP", REPORT)):
            self.classes.update(dict.fromkeys(words.split(), name))
        self.by_length = defaultdict(dict)
        for s, w in self.stems.items():
            self.by_length[len(s)][s] = w
        self._dense_words = frozenset(d for d in self.dense if not d.endswith("*"))
        self._dense_stems = tuple(d[:-1] for d in self.dense if d.endswith("*"))
        self._finder = None

    def __getstate__(self):
        return {"words": self.words, "stems": self.stems, "dense": self.dense, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def finder(self):
        """An automaton that finds where any scored arc may begin."""
        if self._finder is None:
            import ahocorasick

            a = ahocorasick.Automaton()
            for s in {*self.words, *self.stems, *THREAT.split(), *(d.rstrip("*") for d in self.dense)}:
                a.add_word(s, len(s))
            a.make_automaton()
            self._finder = a
        return self._finder

    def insult(self, token: str) -> float | None:
        w = self.words.get(token)
        for n, stems in self.by_length.items():
            if len(token) >= n and (v := stems.get(token[:n])) is not None:
                w = v if w is None else max(v, w)
        return w

    def classify(self, token: str) -> tuple[str, float, frozenset]:
        """The lexical transducer's arc for one token."""
        if token in "\"“”„«»":
            return "QUO", 0.0, frozenset()
        if (w := self.insult(token)) is not None:
            return "INS", w, frozenset()
        if token in self._dense_words or (self._dense_stems and token.startswith(self._dense_stems)):
            return "DNS", 1.0, frozenset()
        return self.classes.get(token, "OTH"), 0.0, frozenset()

    def clause(self, clause: str) -> dict[str, float]:
        """Weight by context of the scored items of one lower-cased clause."""
        tape = [self.classify(m[0]) for m in WORD.finditer(clause)]
        for t in CASCADE:
            tape = t(tape)
        found: dict[str, float] = {}
        for s, w, marks in tape:
            kind = next((k for k in ("negated", "reported") if k in marks), None)
            if "threat" in marks:
                kind, w = kind or "threat", 1.0
            elif s == "DNS":
                found["dense"] = found.get("dense", 0.0) + 1
                continue
            elif s == "INS":
                kind = kind or ("targeted" if "targeted" in marks else "plain")
            else:
                continue
            found[kind] = max(found.get(kind, 0.0), w)
        return found

    def features(self, text: str | None) -> tuple[float, ...]:
        """Summed clause weights by context over the whole text."""
        sums = dict.fromkeys(CONTEXTS, 0.0)
        if text:
            low = text.lower()
            done = -1
            for end, n in self.finder().iter(low):
                at = end - n + 1
                if at <= done or (at and (low[at - 1].isalnum())):
                    continue
                begin = max(low.rfind(c, done + 1, at) for c in CLAUSE_END) + 1
                begin = max(begin, done + 1)
                stops = [p for c in CLAUSE_END if (p := low.find(c, at)) >= 0]
                done = min(stops, default=len(low))
                for k, w in self.clause(low[begin:done]).items():
                    sums[k] += w
            if n := sums["dense"]:
                sums["dense"] = float(n >= 2 and n * SPARSE >= len(low.split()))
        return tuple(sums.values())

    def score(self, features) -> float:
        w = self.weights
        z = w["bias"] + sum(w[k] * min(1.0, v) + 0.5 * math.log1p(max(0.0, v - 1)) for k, v in zip(CONTEXTS, features) if v)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _candidates(text: str, least: int, most: int) -> set[str]:
    """The word forms of a text and, with a trailing ``*``, their stems; those
    that are dense in it once more with a trailing ``+``."""
    forms = Counter(w for m in WORD.finditer(text.lower()) if (w := m[0])[0].isalpha())
    found = Counter(forms)
    for w, n in forms.items():
        for k in range(least, min(most, len(w) - 1) + 1):
            found[w[:k] + "*"] += n
    enough = max(2, forms.total() / SPARSE)
    return found.keys() | {c + "+" for c, n in found.items() if n >= enough}


def _walk_down(supports: dict[str, frozenset], word: str) -> str:
    """A stem whose support one longer stem or one word form nearly has as a
    whole stands for that one; follow until the support spreads out."""
    while word.endswith("*"):
        base, own = word[:-1], supports[word]
        longer = [x for x in supports if x != word and x.startswith(base) and len(x.rstrip("*")) > len(base) and len(supports[x]) >= 0.9 * len(own)]
        if not longer:
            return word
        word = max(longer, key=lambda x: (len(supports[x]), -len(x), x))
    return word


def choose_arcs(supports: dict[str, frozenset], clean: dict[str, int], n_toxic: int, n_clean: int) -> tuple[dict[str, float], list[str]]:
    """Arcs with weights, and dense arcs, from pure candidates (``supports``: the
    toxic sample rows of each).

    First every candidate that a good share of the toxic rows holds, the dense
    ones after the others, then a greedy cover of the rows still unexplained.
    """
    plain = {c: s for c, s in supports.items() if not c.endswith("+")}
    dense = {c[:-1]: s for c, s in supports.items() if c.endswith("+")}
    arcs: dict[str, float] = {}
    dense_arcs: list[str] = []
    left = set().union(*supports.values()) if supports else set()

    def add(c: str, of: dict) -> None:
        if of is dense:
            dense_arcs.append(c)
        else:
            odds = math.log((len(of[c]) + 0.1) / (n_toxic + 0.2)) - math.log((clean.get(c, 0) + 0.5) / (n_clean + 1))
            arcs[c] = max(0.2, min(1.0, odds / 5))
        left.difference_update(of[c])

    def held(c: str) -> bool:
        return any(a.endswith("*") and c.startswith(a[:-1]) for a in (*arcs, *dense_arcs))

    for of in (plain, dense):
        for c in sorted((c for c in of if len(of[c]) >= max(6, 0.03 * n_toxic)), key=lambda c: (-len(of[c]), len(c), c)):
            c = _walk_down(of, c)
            new = len(of[c] & left) >= 0.3 * len(of[c]) if of is dense else True
            if c not in arcs and c not in dense_arcs and not held(c) and new:
                add(c, of)
    gain = 2 if n_toxic < 400 else 3
    for of in (plain, dense):
        rest = {c: s for c, s in of.items() if len(s & left) >= gain and not held(c)}
        while rest:
            best = _walk_down(of, max(rest, key=lambda c: (len(rest[c] & left), c.endswith("*"), -len(c), c)))
            add(best, of)
            rest = {c: s for c, s in rest.items() if c != best and len(s & left) >= gain}
    return arcs, dense_arcs


def sample_rows(docs: DataFrame, labels: DataFrame, train, max_toxic: int, max_clean: int) -> DataFrame:
    """At most ``max_toxic`` + ``max_clean`` labelled training rows (text, toxic), in hash order.

    The ids are chosen first, from the two small columns alone, so only the
    sampled texts move.
    """
    ids = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y")).filter("_id is not null and _y in (0, 1)").filter(train(F.col("_id"))).groupBy("_id").agg(F.max("_y").alias("_y"))
    order = F.xxhash64("_id")
    some = ids.filter("_y = 1").orderBy(order, "_id").limit(max_toxic).union(ids.filter("_y = 0").orderBy(order, "_id").limit(max_clean))
    return docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_t")).filter(F.col("_t").isNotNull()).join(F.broadcast(some), "_id")


def fit(docs: DataFrame, labels: DataFrame, train=lambda doc_id: F.lit(True), max_toxic: int = 2000, max_clean: int = 6000, least: int = 4, most: int = 7) -> Grammar:
    """Learn the arcs and the context weights from a bounded labelled sample."""
    bounded_batches(docs.sparkSession)
    rows = stage(sample_rows(docs, labels, train, max_toxic, max_clean), "toxicity-sample")
    sizes = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic:
        return Grammar()

    def counter(only: frozenset | None):
        def count(batches):
            seen = Counter()
            for pdf in batches:
                for t in pdf["_t"]:
                    found = _candidates(t, least, most)
                    seen.update(found if only is None else found & only)
            yield pd.DataFrame({"c": pd.Series(list(seen), dtype=object), "n": pd.Series(list(seen.values()), dtype="int64")})

        return count

    def counts(y: int, only: frozenset | None, least_n: int) -> dict[str, int]:
        found = rows.filter(F.col("_y") == y).mapInPandas(counter(only), "c string, n bigint")
        return {r["c"]: r["n"] for r in found.groupBy("c").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n).collect()}

    # all three collects are bounded by the sample's own size
    shared = counts(1, None, 2 if n_toxic < 400 else 3)
    clean = counts(0, frozenset(shared), 1)
    impure = lambda c: 0.03 if c.endswith("+") else 0.004
    pure = frozenset(c for c, n in shared.items() if clean.get(c, 0) * n_toxic <= impure(c) * n * max(1, n_clean))

    def holders(batches):
        for pdf in batches:
            pairs = [(c, int(i)) for i, t in zip(pdf["_id"], pdf["_t"]) for c in sorted(_candidates(t, least, most) & pure)]
            yield pd.DataFrame({"c": pd.Series([c for c, _ in pairs], dtype=object), "i": pd.Series([i for _, i in pairs], dtype="int64")})

    supports: dict[str, set] = defaultdict(set)
    for r in rows.filter("_y = 1").mapInPandas(holders, "c string, i bigint").collect():
        supports[r["c"]].add(r["i"])
    arcs, dense = choose_arcs({c: frozenset(s) for c, s in supports.items()}, clean, n_toxic, n_clean)
    words = {**Grammar().words, **{a: w for a, w in arcs.items() if not a.endswith("*")}}
    grammar = Grammar(words, {a[:-1]: w for a, w in arcs.items() if a.endswith("*")}, tuple(dense))
    grammar.weights = _calibrate(grammar, rows)
    return grammar


def _calibrate(grammar: Grammar, rows: DataFrame, steps: int = 300, ridge: float = 0.02) -> dict[str, float]:
    """Context weights by logistic regression on the sample, drawn towards the prior."""

    def feature(batches):
        for pdf in batches:
            f = [[min(1.0, v) for v in grammar.features(t)] for t in pdf["_t"]]
            yield pd.DataFrame([(*x, y) for x, y in zip(f, pdf["_y"])], columns=[*CONTEXTS, "y"]).groupby([*CONTEXTS, "y"], as_index=False).size()

    got = rows.mapInPandas(feature, ", ".join(f"{c} double" for c in CONTEXTS) + ", y int, size bigint")
    got = got.groupBy(*CONTEXTS, "y").agg(F.sum("size").alias("n")).collect()
    if not got:
        return dict(PRIOR)
    x = np.array([[1.0, *(r[c] for c in CONTEXTS)] for r in got])
    y, n = np.array([r["y"] for r in got], float), np.array([r["n"] for r in got], float)
    prior = np.array([PRIOR["bias"], *(PRIOR[c] for c in CONTEXTS)])
    w = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (n * (p - y)) + ridge * (w - prior)
        h = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return dict(zip(("bias", *CONTEXTS), map(float, w)))


def score(docs: DataFrame, grammar: Grammar, text: str = "text", score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """``docs`` with the score of each whole text and ``predicted`` (score >= 0.5)."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([grammar.score(grammar.features(t)) for t in texts], dtype="float64")

    out = docs.withColumn(score_col, run.asNondeterministic()(F.col(text)))
    return out.withColumn(predicted_col, (F.col(score_col) >= 0.5).cast("int"))
