"""Toxicity by a weighted finite-state pattern grammar.

Token classes (insult, threat, target, negation, report, other) are the
alphabet. Four small transducers read it: the insult and threat transducers
weigh what they match, the target transducer remembers an addressed person,
the negation transducer turns matches a few tokens after a negation, and the
reported-speech transducer marks what follows a verb of saying. Their product
runs over each clause once; a clause counts by the pattern it ends in, so
"you are an idiot" and "she said he is no idiot" weigh differently. A second
product reads phrases of several words: a threat chain (speaker, future, verb
of harm, victim or the victim's own), an ill wish (person, modal, verb of
dying) and an insult behind an intensifier, each asserted, negated or reported
by the same two transducers. A logistic layer over the pattern weights gives
the score; only asserted matches make a clause count as such.

The insult lexicon (words and word beginnings) and the layer are learned from
labelled rows that are not held out, at most ``POSITIVES`` and ``NEGATIVES`` of
them, taken by id hash. A lexicon entry must explain documents of several
unlike families, so copies of one document add nothing.

Defined results: a null or empty text matches nothing and gets the score of
the bias alone; repeated rows score one by one; without labels the built-in
words and prior weights score; an empty table gives no rows; labels with null
id or null value are ignored, an id labelled twice is toxic if any row says so;
extra columns of any name are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import held_out, map_texts, one_text_each, texts

THRESHOLD = 0.3
#: Bounds of the training sample, rows of each label.
POSITIVES, NEGATIVES = 2500, 4000
#: Bounds of the lexicon search: candidates kept, families an entry must newly
#: explain, families' coverage wanted, log-odds an entry must reach.
CANDIDATES, MIN_GAIN, COVER, MIN_ODDS = 6000, 3.0, 8, 2.0
PREFIXES = (4, 5, 6, 7, 8)

# Built-in words: a small multilingual start; the learned lexicon goes before it.
INSULTS = "idiot idiots moron morons imbecile scum vermin dumbass asshole idiota idiotas imbécile connard abruti idiotin trottel dummkopf".split()
THREATS = "kill murder shoot stab strangle hang töten umbringen erschießen tuer étrangler matar disparar".split()
TARGETS = "you your yours yourself u ur he she they them his her their du dich dir ihr euch sie toi tu te vous votre tú usted ustedes vosotros".split()
NEGATIONS = "not no never neither nor isn aren wasn don doesn didn nicht kein keine nie pas jamais aucun nunca ni ningún".split()
REPORTS = "said says say told tells called calls claimed claims wrote writes quoted reported sagte sagt schrieb nannte dit disait écrit appelé dijo dice llamó escribió".split()

# Words of the phrases; some are of a class above in the clause patterns.
SELF = "i we ich wir je nous yo nosotros".split()
FUTURE = "will ll gonna going shall werde werden vais allons voy vamos".split()
HARM = "burn hurt beat smash crush destroy break cut punch slap gut poison drown schlagen verbrennen brûler frapper quemar golpear".split()
DOOM = "die perish rot suffer burn sterben verrecken crever mourir morir".split()
MODAL = "should must deserve deserves hope wish ought sollst solltest sollt verdienst devrais devriez mérites espère deberías mereces espero".split()
POSSESSIVE = "your his their her dein deine deinen ta ton tes votre vos tu tus su".split()
OWNED = "house home family face head throat neck legs arms car kids children wife husband mother haus familie gesicht maison famille visage casa familia cara".split()
INTENSE = "fucking bloody damn damned stupid absolute complete total utter such worthless verdammter verdammte dummer dumme sale gros pauvre maldito maldita puto".split()

#: Tokens whose classes a task remembers.
MEMO_TOKENS = 200_000

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
TOKEN = re.compile(r"[^\W\d_]+|[.!?;:,\n()\"“”«»|]")
LETTERS = re.compile(r"[^\W\d_]+")
NEGATION_REACH = 3
#: Classes that only the phrases know; a word may be in several.
SPEAKER, TO_COME, HARMS, DIES, WISHES, OWNERS, GOODS, STRONG = (1 << k for k in range(8))
#: Words that may stand between two steps of a threat chain.
CHAIN_REACH = 4
#: Weight of a phrase that has none from the lexicon.
PHRASE_WEIGHT = 2.0

#: Patterns a clause can end in, and modifiers; one feature each, and two more.
PATTERNS, MODIFIERS = ("insult", "insult+target", "threat+target"), ("asserted", "negated", "reported")
PHRASES = ("threat chain", "ill wish", "intensified insult")
N_FEATURES = (len(PATTERNS) + len(PHRASES)) * len(MODIFIERS) + 2
#: Prior mean of the layer: bias, then pattern x modifier, phrase x modifier,
#: largest asserted clause, share of clauses that assert something.
PRIOR = np.array([-3.5, 2.0, 0.5, 0.7, 3.0, 0.7, 1.0, 3.0, 0.7, 1.0,
                  3.0, 0.3, 0.7, 3.0, 0.3, 0.7, 1.0, 0.0, 0.0, 1.0, 0.5])


# Each transducer: (state, class) -> (state, output). Outputs name what the
# token adds to the clause; the product below pairs the states up.
def _insult(state, cls):
    return state, "insult" if cls == INSULT else "threat" if cls == THREAT else ""


def _target(state, cls):
    return (1 if cls == TARGET else state), ""


def _negation(state, cls):
    if cls == NEGATION:
        return NEGATION_REACH, ""
    return max(0, state - 1), "negated" if state and cls in (INSULT, THREAT) else ""


def _report(state, cls):
    return (1 if cls == REPORT else state), "reported" if state and cls in (INSULT, THREAT) else ""


TRANSDUCERS = (_insult, _target, _negation, _report)


@cache
def composed() -> tuple[list[list[tuple[int, str, str]]], list[bool]]:
    """The product automaton: per state and class (next state, match, modifier),
    and whether a state has seen a target."""
    start = (0,) * len(TRANSDUCERS)
    number, arcs, todo = {start: 0}, [], [start]
    while todo:
        state = todo.pop(0)
        row = []
        for cls in range(6):
            steps = [t(s, cls) for t, s in zip(TRANSDUCERS, state)]
            to = tuple(s for s, _ in steps)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append((number[to], steps[0][1], steps[2][1] or steps[3][1] or ("asserted" if steps[0][1] else "")))
        arcs.append(row)
    return arcs, [bool(s[1]) for s in number]


# Phrase transducers: (state, class, phrase classes) -> (state, whether the phrase ends here).
def _chain(state, cls, of):
    """Speaker, future, verb of harm, then the victim or what is the victim's."""
    step, left = state
    if step == 3 and (cls == TARGET and not of & OWNERS):
        return (0, 0), True
    if step == 4 and of & GOODS:
        return (0, 0), True
    if step == 3 and of & OWNERS:
        return (4, CHAIN_REACH), False
    if step == 2 and (cls == THREAT or of & HARMS):
        return (3, CHAIN_REACH), False
    if step == 1 and of & TO_COME:
        return (2, CHAIN_REACH), False
    if of & SPEAKER:
        return (1, CHAIN_REACH), False
    return ((step, left - 1) if left else (0, 0)), False


def _wish(state, cls, of):
    """A person and a modal verb, in either order, then a verb of dying."""
    if state == 3 and of & DIES:
        return 0, True
    return state | (cls == TARGET) | 2 * bool(of & WISHES), False


def _intensified(state, cls, of):
    """An insult right behind an intensifier."""
    return int(bool(of & STRONG)), bool(state and cls == INSULT)


PHRASE_TRANSDUCERS = (_chain, _wish, _intensified)


class PhraseProduct:
    """Product of the phrase, negation and report transducers, its arcs made
    when first taken: state and word classes to (next state, phrases that end
    here, modifier)."""

    def __init__(self):
        self.start = ((0, 0), 0, 0, 0, 0)
        self.arcs: dict = {}

    def step(self, state, cls, of):
        arc = self.arcs.get((state, cls, of))
        if arc is None:
            *phrases, negation, report = state
            steps = [t(s, cls, of) for t, s in zip(PHRASE_TRANSDUCERS, phrases)]
            to = (*(s for s, _ in steps), _negation(negation, cls)[0], _report(report, cls)[0])
            how = "negated" if negation else "reported" if report else "asserted"
            arc = self.arcs[state, cls, of] = to, [k for k, (_, ends) in enumerate(steps) if ends], how
        return arc


@cache
def phrase_product() -> PhraseProduct:
    return PhraseProduct()


def clauses(text: str):
    """Lists of word tokens between punctuation marks and line ends."""
    clause = []
    for token in TOKEN.findall(text):
        if token[0].isalpha():
            clause.append(token)
        elif clause:
            yield clause
            clause = []
    if clause:
        yield clause


#: Marks tokens that hold an insult or threat.
MATCHES = 1 << 8


def can_match(held) -> bool:
    """Whether tokens that hold these classes can match any pattern or phrase."""
    got = 0
    for h in held:
        got |= h
    return bool(got & MATCHES or got & (DIES | WISHES) == DIES | WISHES
                or got & (SPEAKER | TO_COME | HARMS) == SPEAKER | TO_COME | HARMS)


@dataclass
class Model:
    words: dict[str, float]
    prefixes: dict[str, float]
    layer: np.ndarray

    def __post_init__(self):
        self.fixed = {w: (INSULT, 2.0) for w in INSULTS} | {w: (THREAT, 2.0) for w in THREATS} | \
            {w: (TARGET, 0.0) for w in TARGETS} | {w: (NEGATION, 0.0) for w in NEGATIONS} | \
            {w: (REPORT, 0.0) for w in REPORTS}
        self.phrase: dict[str, int] = {}
        for cls, words in ((SPEAKER, SELF), (TO_COME, FUTURE), (HARMS, HARM), (DIES, DOOM), (WISHES, MODAL),
                           (OWNERS, POSSESSIVE), (GOODS, OWNED), (STRONG, INTENSE)):
            for w in words:
                self.phrase[w] = self.phrase.get(w, 0) | cls

    def classify(self, word: str) -> tuple[int, float]:
        weight = self.words.get(word)
        if weight is None:
            weight = max((self.prefixes.get(word[:k], 0.0) for k in PREFIXES if len(word) >= k), default=0.0)
        return (INSULT, weight) if weight else self.fixed.get(word, (OTHER, 0.0))

    def holds(self, words: list[str]) -> int:
        """Phrase classes among the words, and MATCHES if one is an insult or threat."""
        got = 0
        for w in words:
            got |= self.phrase.get(w, 0) | MATCHES * (self.classify(w)[0] in (INSULT, THREAT))
        return got

    def features(self, text: str, match: dict) -> np.ndarray | None:
        """Pattern weights of a text; None when nothing in it can match.
        ``match`` remembers what blank-separated tokens hold."""
        low = text.lower()
        tokens = set(low.split())
        for t in tokens.difference(match):
            match[t] = self.holds(LETTERS.findall(t))
        if not can_match(map(match.__getitem__, tokens)):
            return None
        arcs, has_target = composed()
        product = phrase_product()
        sums = np.zeros((len(PATTERNS) + len(PHRASES)) * len(MODIFIERS))
        largest = matched = total = 0.0
        for clause in clauses(low):
            total += 1
            state, at, got, phrases = 0, product.start, {}, []
            for word in clause:
                cls, weight = self.classify(word)
                state, what, how = arcs[state][cls]
                if what:
                    got[what, how] = got.get((what, how), 0.0) + weight
                at, ends, how = product.step(at, cls, self.phrase.get(word, 0))
                phrases += [(len(PATTERNS) + k, how, weight or PHRASE_WEIGHT) for k in ends]
            for (what, how), w in got.items():
                if what == "insult":
                    phrases.append((int(has_target[state]), how, w))
                elif has_target[state]:
                    phrases.append((2, how, w))
            asserted = 0.0
            for pattern, how, w in phrases:
                sums[pattern * len(MODIFIERS) + MODIFIERS.index(how)] += w
                asserted += w * (how == "asserted")
            matched += asserted > 0
            largest = max(largest, asserted)
        return np.concatenate([np.log1p(sums), [math.log1p(largest), matched / max(total, 1.0)]])

    def score(self, x: np.ndarray | None) -> float:
        z = self.layer[0] + (0.0 if x is None else float(self.layer[1:] @ x))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def fit_layer(x: np.ndarray, y: np.ndarray, of: np.ndarray, strength: float = 1.0) -> np.ndarray:
    """Logistic layer drawn to PRIOR with the given strength (Newton steps).
    ``of`` is the weight of each row."""
    x = np.column_stack([np.ones(len(x)), x]) if len(x) else np.zeros((0, len(PRIOR)))
    w = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ ((p - y) * of) + strength * (w - PRIOR)
        hess = (x * (of * p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sample(labels: DataFrame, column: str, positives: int, negatives: int) -> DataFrame:
    """At most so many labelled ids of each value that are not held out, by id hash."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
            .groupBy("doc_id").agg(F.max("label").alias("label")))
    order = F.xxhash64(F.lit(11), "doc_id")
    return (rows.where("label = 1").orderBy(order, "doc_id").limit(positives)
            .unionByName(rows.where("label = 0").orderBy(order, "doc_id").limit(negatives)))


def row_weights(y: np.ndarray, labels: DataFrame, column: str) -> np.ndarray:
    """Weights that give a sample (``y``) the shares of all training labels, mean 1."""
    rows = labels.where(~held_out()).groupBy(F.col(column).cast("int").alias("label")).count().collect()
    n = {r["label"]: r["count"] for r in rows}
    w = np.where(y == 1, n[1] / max((y == 1).sum(), 1), n[0] / max((y == 0).sum(), 1))
    return w * len(y) / w.sum()


def _items(text: str) -> set[str]:
    """Words and word beginnings; a beginning carries a trailing star."""
    words = set(LETTERS.findall(text.lower()))
    return words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) > k}


def _count(rows: dict) -> dict:
    from collections import Counter
    n = (Counter(), Counter())
    for text, label in zip(rows["text"], rows["label"]):
        n[label].update(_items(text))
    items = list(n[0].keys() | n[1].keys())
    return {"item": items, "pos": [n[1][i] for i in items], "neg": [n[0][i] for i in items]}


def learn_lexicon(rows: list, candidates: list[str], n_pos: int, n_neg: int) -> dict[str, float]:
    """Entries chosen greedily so that every toxic document is explained by up
    to COVER of them. Documents weigh one per family (rows: label, family,
    candidate numbers)."""
    size: dict[int, int] = {}
    for label, family, _ in rows:
        if label:
            size[family] = size.get(family, 0) + 1
    pos = [(1.0 / size[f], set(own)) for label, f, own in rows if label]
    has: dict[int, list[int]] = {}
    for d, (_, own) in enumerate(pos):
        for c in own:
            has.setdefault(c, []).append(d)
    neg = np.zeros(len(candidates))
    for label, _, own in rows:
        if not label:
            neg[list(own)] += 1
    want = np.full(len(pos), COVER)
    weight = np.array([w for w, _ in pos])
    entries: dict[str, float] = {}
    # stale gains only shrink, so the best is found by re-weighing from the top
    gain = {c: weight[ds].sum() for c, ds in has.items()}
    while gain:
        best, top = None, -1.0
        for c in sorted(gain, key=lambda c: -gain[c]):
            if gain[c] < max(MIN_GAIN, top):
                break
            ds = has[c]
            gain[c] = float((weight[ds] * (want[ds] > 0)).sum())
            worth = gain[c] - 2.0 * neg[c]
            if worth >= MIN_GAIN and (worth > top or worth == top and _narrower(candidates[c], candidates[best])):
                best, top = c, worth
        if best is None:
            break
        ds = has[best]
        odds = math.log((weight[ds].sum() + 0.5) / (n_pos + 1)) - math.log((neg[best] + 0.5) / (n_neg + 1))
        if odds >= MIN_ODDS:
            entries[candidates[best]] = min(odds, 6.0)
            want[ds] -= 1
        own = set(ds)
        for c in [c for c in gain if len(has[c]) <= len(own) and own.issuperset(has[c])]:
            del gain[c]  # says nothing that the entry doesn't
    return entries


def _narrower(entry: str, other: str) -> bool:
    """Whole words before word beginnings, then the longer."""
    return (entry[-1] != "*", len(entry)) > (other[-1] != "*", len(other))


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> Model:
    """Lexicon and layer from the labelled, not held out documents of ``docs``."""
    # bounded by positives + negatives rows of two numbers
    train = one_text_each(texts(docs).join(F.broadcast(sample(labels, "toxic", positives, negatives)), "doc_id"))
    n = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = n.get(1, 0), n.get(0, 0)
    model = Model({}, {}, PRIOR)
    if not n_pos or not n_neg:
        return model
    counts = map_texts(train, _count, "item string, pos long, neg long").groupBy("item").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1.0)) - F.log((F.col("neg") + 0.5) / (n_neg + 1.0))
    best = (counts.where((F.col("pos") >= MIN_GAIN) & (odds >= MIN_ODDS))
            .orderBy((F.col("pos") * odds).desc(), "item").limit(CANDIDATES).select("item").collect())
    candidates = [r["item"] for r in best]
    index = {c: k for k, c in enumerate(candidates)}

    def hits(rows: dict) -> dict:
        own, family = [], []
        for text in rows["text"]:
            own.append([index[i] for i in _items(text) if i in index])
            h = np.array([hash_word(w) for w in set(LETTERS.findall(text.lower()))] or [0], np.uint64)
            family.append(int(h.min() >> np.uint64(1)))
        return {"label": rows["label"], "family": family, "own": own}

    rows = [(r["label"], r["family"], r["own"]) for r in map_texts(train, hits, "label int, family long, own array<int>").collect()]
    entries = learn_lexicon(rows, candidates, n_pos, n_neg)
    model = Model({e: w for e, w in entries.items() if e[-1] != "*"},
                  {e[:-1]: w for e, w in entries.items() if e[-1] == "*"}, PRIOR)

    def measured(rows: dict) -> dict:
        memo: dict = {}
        x = [model.features(t, memo) for t in rows["text"]]
        return {"label": rows["label"], "x": [[0.0] * N_FEATURES if v is None else v.tolist() for v in x]}

    got = map_texts(train, measured, "label int, x array<double>").collect()
    model.layer = fit_layer(np.array([r["x"] for r in got]), y := np.array([r["label"] for r in got], float),
                            row_weights(y, labels, "toxic"))
    return model


def hash_word(word: str) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    memo: dict = {}

    def scored(rows: dict) -> dict:
        if len(memo) > MEMO_TOKENS:
            memo.clear()
        s = [model.score(model.features(t, memo)) for t in rows["text"]]
        return {"doc_id": rows["doc_id"], "score": s, "predicted": [int(x >= threshold) for x in s]}

    out = map_texts(texts(docs), scored, "doc_id long, score double, predicted int")
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text scores at the threshold or above."""
    memo: dict = {}

    @F.pandas_udf("boolean")
    def clean(col):
        if len(memo) > MEMO_TOKENS:
            memo.clear()
        return col.map(lambda t: model.score(model.features(t or "", memo)) < threshold)

    return docs.where(clean(F.coalesce(F.col("text").cast("string"), F.lit(""))))
