"""License notices with words changed, put in and left out, against all shingles at all places."""

import os
import random
import sys
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from onoma.llm import licenses


def test_damaged_notices_are_found(spark):
    rng, rows = random.Random(11), []
    lines = {k: licenses.clean_words(v) for k, v in licenses.LINES.items() if len(licenses.clean_words(v)) >= 10}
    for k in range(3000):
        name = rng.choice(sorted(lines))
        w = list(lines[name])
        for _ in range(rng.randint(1, 1 + len(w) // 20)):
            at = rng.randrange(len(w))
            w[at : at + rng.choice([0, 1, 1])] = rng.choice([[], ["changed"], [f"put{rng.randint(0, 99)}"] * rng.randint(1, 3)])
        rows.append((k, " ".join([f"lead{x}" for x in range(rng.randint(0, 30))] + w + ["tail"] * rng.randint(0, 9))))
    want = defaultdict(set)
    for k, text in rows:
        w = licenses.clean_words(text)
        have = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        for name, n in lines.items():
            own = {tuple(n[i : i + 5]) for i in range(len(n) - 4)}
            take = len(n) - 2 + -(-len(n) // 5)
            if any(x in own and len(own & set(have[i : i + take])) >= 0.8 * len(own) for i, x in enumerate(have)):
                want[k].add(name)
    got = defaultdict(set)
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), {k: licenses.LINES[k] for k in lines}).collect():
        got[r.doc_id].add(r.license)
    assert sum(map(len, want.values())) > 500
    lost = [(k, x) for k in want for x in want[k] - got[k]]
    assert not lost and all(got[k] <= want[k] for k in got), lost[:5]
