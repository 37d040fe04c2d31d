"""Entity resolution against the plain sequential loop, on every execution path."""

import random
import string
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from garimpo.functions.similarity import TextSet, lcs_length, ratio, reaches, token_ratio
from garimpo.functions.text import fold_strip, sort_tokens
from garimpo.operators import resolve as R
from garimpo.plans.silver import resolve
from garimpo.schemas import COMPANIES, JOBS, LOCATIONS, RAW_JOBS

PATHS = {
    "windows": R.Limits(),
    "components": R.Limits(group_nodes=12, block_companies=50, first_peel=4),
    "rounds": R.Limits(group_nodes=2, block_companies=2, first_peel=2),
}


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def slow_leaders(rows, title=85, company=90):
    """rows: (kid, window, title_k, company_k, forced, ord) -> {kid: leader}."""
    leaders, chosen = [], {}
    for kid, window, t, c, forced, _ in sorted(rows, key=lambda r: r[5]):
        for lead in leaders:
            if lead[1] == window and reaches(t, lead[2], title) and reaches(c, lead[3], company):
                chosen[kid] = lead[0]
                break
        if forced or kid not in chosen:
            leaders.append((kid, window, t, c))
        chosen.setdefault(kid, kid)
    return chosen


def edited(text, rng, most=3):
    for _ in range(rng.randint(0, most)):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1 :], text[:i] + rng.choice("abcde ") + text[i:]]) or "a"
    return text


def random_nodes(seed, count):
    rng = random.Random(seed)

    def word(low, high):
        return "".join(rng.choice("abcde") for _ in range(rng.randint(low, high)))

    titles = [" ".join(word(2, 8) for _ in range(rng.randint(1, 4))) for _ in range(7)] + ["ab", "abc", "abcd"]
    companies = [word(8, 14) for _ in range(2)] + ["x", "customer#000000001", "customer#000000002"]
    rows, seen = [], set()
    for i in range(count):
        key = (
            rng.choice(["unknown", "unknown", "1", "2"]),
            " ".join(sorted(edited(rng.choice(titles), rng).split())) or "a",
            " ".join(sorted(edited(rng.choice(companies), rng, 1).split())) or "b",
        )
        if key in seen:
            continue
        seen.add(key)
        forced = rng.random() < 0.15
        rows.append((f"k{i}", *key, forced, f"{'0' if forced else '1'}{rng.randrange(10**6):09d}{i:05d}"))
    return rows


def test_lcs_and_ratio():
    rng = random.Random(7)
    for _ in range(500):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 20))) for _ in "xy")
        assert lcs_length(a, b) == slow_lcs(a, b)
    assert ratio("", "") == 100.0 and ratio("abc", "abd") == pytest.approx(200 * 2 / 6)
    assert reaches("a" * 17 + "bbb", "a" * 17 + "ccc", 85)  # exactly 85


def test_text_set_agrees_with_single_pairs():
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.choice([1, 3, 12, 40, 62, 63, 64, 90]))) for _ in range(40)]
    texts += [edited(t, rng, 6) for t in texts]
    group = TextSet(texts)
    everyone = np.arange(len(texts))
    for threshold in (60, 85, 100):
        for i, text in enumerate(texts):
            wanted = [j for j in everyone if reaches(text, texts[j], threshold)]
            assert group.reached(i, everyone, threshold).tolist() == wanted
            assert group.first_reached(i, everyone, threshold) == wanted[0]
        square = group.matrix(threshold, block=7)
        assert [[bool(square[i, j]) for j in everyone] for i in everyone] == [
            [reaches(a, b, threshold) for b in texts] for a in texts
        ]
    assert group.first_reached(0, np.array([], dtype=np.int64), 85) == -1


def test_token_ratio(evaluate):
    def build():
        a, b = (sort_tokens(fold_strip(F.col(c))) for c in "ab")
        return token_ratio(a, b)

    rows = [("Senior Engenheiro de Dados", "Engenheiro de Dados Senior"),
            ("Engenheiro de Dados Sr.", "Engenheiro de Dados Senior"),
            ("Engenheiro de Dados", "Analista de BI")]
    values = evaluate(build, rows, "a string, b string")
    assert values[0] == 100.0 and values[1] >= 85 and values[2] < 85


def test_signatures_lose_no_pair():
    rng = random.Random(3)
    hits = 0
    for threshold in (85, 90):
        for degree, longest in ((1, 0), (2, 8), (2, 40), (3, 12), (3, 40)):
            for _ in range(3000):
                a = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 22)))
                b = edited(a, rng, 4)
                if not reaches(a, b, threshold):
                    continue
                hits += 1
                ranks = {x + y: rng.randrange(9) for x in "abcde " for y in "abcd"}
                one, two = (set(R.signature_terms(t, threshold, ranks, degree, longest)) for t in (a, b))
                assert one & two, (a, b, threshold, degree, longest)
                more = [set(R.signature_terms(t, threshold, ranks, common=4)) for t in (a, b)]
                need = min(4, max(R.sure_pairs(min(len(a), len(b)), threshold), 1))
                assert len(more[0] & more[1]) >= need, (a, b, threshold)
    assert hits > 3000


@pytest.mark.parametrize("path", PATHS)
def test_leaders_match_the_loop(spark, path):
    rows = random_nodes(11, 260)
    frame = spark.createDataFrame(
        rows, "kid string, window string, title_k string, company_k string, forced boolean, ord string"
    )
    got = {r["kid"]: r["leader_kid"] for r in R.assign_leaders(frame, limits=PATHS[path]).collect()}
    wanted = slow_leaders(rows)
    assert got == wanted
    assert len(set(wanted.values())) < len(rows) * 0.8


def test_needed_terms_agree(spark):
    for threshold in (81, 85, 90, 99, 100):
        sizes = spark.range(1, 200).select("id", R.needed_terms(F.col("id"), threshold, 4).alias("n")).collect()
        sure = [1 if threshold == 100 else max(R.sure_pairs(r["id"], threshold), 1) for r in sizes]
        assert [r["n"] for r in sizes] == [min(4, n) for n in sure]


def test_low_thresholds_are_refused(spark):
    with pytest.raises(ValueError):
        R.assign_leaders(spark.createDataFrame([], "kid string"), 70, 90)


def test_components_keep_similar_names_together(spark):
    rng = random.Random(5)
    names = sorted({edited("".join(rng.choice(string.ascii_lowercase[:6]) for _ in range(9)), rng)
                    for _ in range(150)} | {f"customer#{i:09d}" for i in range(60)})
    frame = spark.createDataFrame([(n,) for n in names], "company_k string")
    for most, few in ((200, 1000), (3, 1000), (200, 1)):
        limits = R.Limits(block_companies=most, few_companies=few)
        label = dict(R.company_components(frame, 90, limits).collect())
        assert set(label) == set(names)
        assert all(label[a] == label[b] for a in names for b in names if a < b and reaches(a, b, 90))


def raw_rows():
    day = date(2026, 5, 20)
    at = datetime(2026, 5, 21, 6)
    rows = [
        ("r1", "adzuna", "a1", "Engenheiro de Dados Senior", "Nubank", "São Paulo", "100% remoto", day, 0),
        ("r2", "jooble", "j1", "Senior Engenheiro de Dados", "NuBank", "SP", "x", day, 1),
        ("r3", "gupy", None, "Engenheiro de Dados Sr.", "nubank", None, "x", day, 2),
        ("r4", "gupy", "g4", "Analista de BI", "Nubank", None, "modelo híbrido", day, 3),
        ("r5", "gupy", "g5", "", "Nubank", "x", "x", day, 4),
        ("r6", "gupy", "g6", "Data Engineer", "iFood", "x", "x", None, 5),
        ("r7", "adzuna", "a7", "Data Engineer", "ifood ", "x", "x", None, 6),
        ("r8", "adzuna", "a8", "Data Scientist", "Known Co", "x", "x", day, 7),
        ("r9", "adzuna", "done", "Data Scientist", "Known Co", "x", "x", day, 8),
    ]
    return [
        (i, s, sid, t, c, loc, d, f"http://x/{i}", p, False, "{}", at - timedelta(minutes=n))
        for i, s, sid, t, c, loc, d, p, n in rows
    ]


@pytest.mark.parametrize("path", ["windows", "rounds"])
def test_resolve_step(spark, path):
    raw = spark.createDataFrame(raw_rows(), RAW_JOBS)
    job = ("j0", ["done"], "h0", "Data  Scientist", "c0", "l0", None, None, [], None, date(2026, 5, 20),
           False, False, datetime(2026, 5, 1), True, None)
    jobs = spark.createDataFrame([job], JOBS)
    companies = spark.createDataFrame([("c0", "Known Co")], COMPANIES)
    locations = spark.createDataFrame([("l0", "X", None, None, "BR", False)], LOCATIONS)
    run = resolve(raw, jobs, companies, locations, "2026-05-21 07:00:00", limits=PATHS[path])
    assert run.stats.collect()[0].asDict() == {"new": 3, "duplicate": 4, "skipped": 1}
    made = {r["title"]: r for r in run.jobs.collect()}
    assert len(made) == 4
    lead = made["Engenheiro de Dados Senior"]
    assert lead["source_ids"] == ["a1", "j1", "r3"] and lead["is_remote"] and len(lead["dedup_hash"]) == 64
    assert made["Analista de BI"]["is_hybrid"] and not made["Analista de BI"]["is_remote"]
    assert made["Data Engineer"]["source_ids"] == ["g6", "a7"]
    assert made["Data  Scientist"]["source_ids"] == ["done", "a8"]
    assert {r["name"] for r in run.companies.collect()} == {"Known Co", "Nubank", "iFood"}
    places = {r["raw"]: r for r in run.locations.collect()}
    assert set(places) == {"X", "São Paulo", "desconhecido"} and places["São Paulo"]["is_remote"]
    assert made["Data Engineer"]["location_id"] == "l0"

    # A second run finds nothing to do except the postings without title and without id.
    again = resolve(raw, spark.createDataFrame(run.jobs.collect(), run.jobs.schema), run.companies,
                    run.locations, "2026-05-22 07:00:00")
    assert again.stats.collect()[0].asDict() == {"new": 0, "duplicate": 1, "skipped": 1}
    assert sorted(map(str, again.jobs.collect())) == sorted(map(str, run.jobs.collect()))
