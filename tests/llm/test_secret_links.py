"""Linked parts of secrets against all pairs."""

import random

import pytest

from tideline.llm import secrets

NEEDS = {3: lambda r: bool(r & {"identifier", "endpoint"}), 4: lambda r: "secret" in r, 5: lambda r: {"secret", "identifier"} <= r}


def brute(text, reach):
    base = secrets.base_spans(text)
    parts = sorted(base + secrets.weak_spans(text, base))
    breaks = [m.start() for m in secrets.BREAK.finditer(text)]
    scope = lambda s: sum(b < s for b in breaks)
    role = lambda k: secrets.ROLES[secrets.KINDS[k]]
    out = list(base)
    for s, k, e in parts:
        if k >= 3:
            near = {role(k2) for s2, k2, e2 in parts if role(k2) != role(k) and scope(s2) == scope(s) and max(s - e2, s2 - e) <= reach}
            if NEEDS[k](near):
                out.append((s, k, e))
    return secrets.listed(sorted(set(out)))


@pytest.mark.parametrize("reach", [256, 40])
def test_links_equal_all_pairs(spark, reach):
    rng = random.Random(reach)
    long_key = "aB3" * 90
    pieces = ["AKIA" + "Q7" * 8, "aB3" * 8, long_key, "user=jane", "https://host.example/x", "https://h.example/" + "p" * 300, "db.example.com:5432", "token = abcdefgh", "0123456789abcdef" * 2, "\n\n", "x " * 30, "x " * 140, "é", "https://h.example/?token=abcdefgh12&u=" + "z" * 600]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randrange(2, 14))) for _ in range(200)]
    # a part of 270 characters directly before an identifier, and directly behind it
    texts += [f"{long_key} AKIA{'Q7' * 8}", f"AKIA{'Q7' * 8} {long_key}", f"{long_key} {'y ' * 126} user=jane AKIA{'Q7' * 8}"]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, kind string, start int")
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs, reach).collect()}
    for i, t in enumerate(texts):
        assert set(got[i].split(",")) == set(brute(t, reach).split(",")), t
    assert "key:0:270" in got[200] and "key:21:291" in got[201]
