from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridlake.llm import ppm as P
from tests.llm.helpers import docs_of, empty_docs, lower


class Brute:
    """The same model, one dictionary per context."""

    def __init__(self, texts, order):
        self.order, self.seen, self.words = order, defaultdict(Counter), Counter()
        for t in texts:
            b = lower(t).encode()
            self.words.update(b.split())
            self.words[b" "] += 1
            a = self.padded(b)
            for j in range(order, len(a)):
                for k in range(order + 1):
                    self.seen[tuple(a[j - k : j])][a[j]] += 1

    def padded(self, b):
        return [256] * self.order + list(b) + [256]

    def symbol(self, context, s):
        out, excluded = 0.0, set()
        for k in range(self.order, -1, -1):
            children = self.seen.get(tuple(context[self.order - k :]))
            if not children:
                continue
            left = {x: n for x, n in children.items() if x not in excluded}
            if left:
                t = sum(left.values())
                if s in left:
                    return out + math.log10((2 * left[s] - 1) / (2 * t))
                out += math.log10(len(left) / (2 * t))
            excluded = set(children)
        return out - math.log10(257 - len(excluded))

    def score(self, t):
        a = self.padded(lower(t).encode())
        return sum(self.symbol(a[j - self.order : j], a[j]) for j in range(self.order, len(a)))

    def base(self, t):
        w = [*lower(t).encode().split(), b" "]
        n, v = sum(self.words.values()), len(self.words)
        return sum(math.log10((self.words[x] + 1) / (n + v + 1)) for x in w), len(w), sum(self.words[x] > 0 for x in w)


@pytest.mark.parametrize("order", [2, 5, 6])
def test_equals_brute_force(spark, order):
    rnd = random.Random(order)
    texts = [" ".join(rnd.choice(("the", "Then", "énd", "a", "b\n")) for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    texts += [None, "", "zzz qqq", "the " * 300]
    docs = docs_of(spark, texts).union(docs_of(spark, {None: "the end", 3: texts[3]})).selectExpr("*", "1 AS block", "2 AS gram")
    train = (F.col("doc_id") % 3 != 0)
    learnt = [t for i, t in enumerate(texts) if i % 3]
    model = Brute(learnt, order)
    rows = P.scores(docs, train, order=order, block_bytes=1500).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        t = "the end" if r.doc_id is None else texts[r.doc_id]
        base, n, known = model.base(t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, sum(model.words.values()))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(model.score(t), rel=1e-9)
    total = sum(10 ** model.symbol([256] * (order - 2) + [116, 104], s) for s in range(257))
    assert total == pytest.approx(1)


def test_without_training_and_empty(spark):
    (r,) = P.scores(docs_of(spark, ["ab"]), F.lit(False)).collect()
    assert (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0)
    assert r.score == pytest.approx(-3 * math.log10(257))
    assert P.scores(empty_docs(spark), F.lit(True)).count() == 0
    with pytest.raises(ValueError, match="order"):
        P.scores(empty_docs(spark), F.lit(True), order=9)
