import hashlib
import re

from tests.llm.fixtures import documents, texts
from tidewell.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    wins = {}
    for item, text in items:
        w = tokens(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[i : i + 13]), set()).add(item)
    out = set()
    for d, text in rows:
        w, hit, found = tokens(text), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[k]
        ids = ",".join(sorted(map(str, found)))
        out.add((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def items(spark):
    t = [x for x in texts(1, 40) if len(x.split()) > 20]
    rows = [(1, " ".join(t[0].split()[:30])), (2, " ".join(t[1].split()[2:16])), (10, " ".join(t[1].split()[2:16])), (3, "a b c d e"), (4, ""), (5, None), (6, "straße abc"), (7, t[2]), (3, "b c")]
    return spark.createDataFrame([(i, x, "e") for i, x in rows], "item_id long, text string, th string"), rows


def test_against_brute_force(spark):
    df, rows = documents(spark)
    bench, brows = items(spark)
    got = {tuple(r) for r in decontaminate.digest(decontaminate.contamination(df, bench)).collect()}
    assert got == brute(rows, brows)
    assert sum(r[2] > 0 for r in got) > 3


def test_empty_sides(spark):
    df, rows = documents(spark)
    bench, _ = items(spark)
    assert decontaminate.contamination(df.limit(0), bench).count() == 0
    none = decontaminate.digest(decontaminate.contamination(df, bench.limit(0)))
    assert none.where("n_hit > 0 or n_items > 0 or contaminated").count() == 0 and none.count() == len(set(rows))
