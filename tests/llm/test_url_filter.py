import math
import zlib
from collections import Counter

import pytest

from barograph.llm import url_filter as uf

URLS = ["https://a.example.org/en/1", "http://EXAMPLE.org/es/x?q=1", "https://b.org/p", "http://x.com/fr/1", "http://y.com/de/2",
        "http://y.com/de/3#t", "https://z.net/en/9", "no scheme", None, "", "ftp://h", "http://notorg/", "http://a.com/fr",
        "http://q.com/de/", "http://example.org/en/2", "https://z.net/en/9", "a://b://c/d", "http://é.com/fr/ü"]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "g", 0.0) for i, u in enumerate(urls)],
                                 "page_id bigint, url string, html string, site string, score double")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([path.index(c) for c in "?#" if c in path] or [len(path)])]


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in uf.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute_scores(sites):
    """Score of each site from the counts of the labelled ones, character by character."""
    grams = {"accepted": Counter(), "rejected": Counter()}
    padded = {s: "\x01" * (uf.ORDER - 1) + s + "\x02" for s, _ in sites}
    for site, label in sites:
        if label:
            for i in range(len(site) + 1):
                gram = padded[site][i:i + uf.ORDER]
                for k in range(1, uf.ORDER + 1):
                    grams[label][gram[-k:], "n"] += 1
                    grams[label][gram[-k:][:-1], k, "m"] += 1
    scores = {}
    for site, _ in sites:
        bits = 0.0
        for i in range(len(site) + 1):
            p = {}
            for label, counts in grams.items():
                p[label] = 1 / uf.SYMBOLS
                for k in range(1, uf.ORDER + 1):
                    tail = padded[site][i:i + uf.ORDER][-k:]
                    p[label] = (counts[tail, "n"] + uf.STRENGTH * p[label]) / (counts[tail[:-1], k, "m"] + uf.STRENGTH)
            bits += math.log2(p["accepted"]) - math.log2(p["rejected"])
        scores[site] = bits / (len(site) + 1)
    return scores


@pytest.mark.parametrize("hot_share", [1 / 2000, 0.02, 2.0])
def test_scores_equal_brute_force(spark, monkeypatch, hot_share):
    monkeypatch.setattr(uf, "HOT_SHARE", hot_share)
    sites = [(f"s{k % 7}.example.{'org' if k % 2 else 'com'}/p{k}", ("accepted", "rejected", None)[k % 3]) for k in range(60)]
    sites += [("", None), ("é/ü", "accepted")]
    df = spark.createDataFrame([(s, int(v == "accepted"), int(v == "rejected")) for s, v in sites],
                               "site string, accepted bigint, rejected bigint")
    found = {r.site: r.score for r in uf.url_scores(df).collect()}
    wanted = brute_scores(sites)
    assert found.keys() == wanted.keys()
    assert all(abs(found[s] - wanted[s]) < 1e-9 for s in wanted)


def test_parts_rules_and_verdicts(spark):
    found = uf.filter_urls(pages(spark, URLS)).collect()
    assert len(found) == len(URLS)
    for r in found:
        host, path = parts(URLS[r.page_id])
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    same = {r.verdict for r in found if r.page_id in (6, 15)}
    assert len(same) == 1


def test_learned_verdicts_follow_the_labels(spark):
    urls = [f"http://good{k}.example.com/fr/{k}" for k in range(200)] + [f"http://bad{k}.spam.com/de/{k}" for k in range(200)]
    urls += [f"http://good{k}.example.net/fr/{k}" for k in range(20)] + [f"http://bad{k}.spam.net/de/{k}" for k in range(20)]
    found = {r.page_id: r.verdict for r in uf.filter_urls(pages(spark, urls)).collect()}
    assert [found[400 + k] for k in range(40)] == ["allow"] * 20 + ["block"] * 20


def test_empty_table_and_missing_class(spark):
    assert uf.filter_urls(pages(spark, [])).count() == 0
    assert uf.filter_urls(pages(spark, ["http://a.net/x", None])).count() == 2


def test_models_see_the_whole_url(spark):
    urls = [*URLS, "http://z.net/en/9", "https://z.net/en/9?a=1", "https://z.net/en/9#a", "other words"]
    found = {urls[r.page_id]: r.score for r in uf.filter_urls(pages(spark, urls)).collect()}
    decided = {u: rule_of(*parts(u))[1] for u in urls}
    with_crc = lambda u: zlib.crc32((u or "").encode()) % 5 == 0
    sites = {u or "": {"allow": "accepted", "block": "rejected"}.get(None if with_crc(u) else decided[u]) for u in urls}
    wanted = brute_scores(list(sites.items()))
    assert all(abs(found[u] - wanted[u or ""]) < 1e-9 for u in urls)
    assert len({found[u] for u in urls[-4:]} | {found["https://z.net/en/9"], found["no scheme"], found[""]}) == 7


def test_verdicts_learn_from_queries(spark):
    urls = [f"http://h{k}.example.com/fr/?ref=good{k}" for k in range(200)] + [f"http://h{k}.spam.com/de/?ad=bad{k}" for k in range(200)]
    urls += [f"http://n{k}.net/p?ref=good{k}" for k in range(20)] + [f"http://n{k}.net/p?ad=bad{k}" for k in range(20)]
    found = {r.page_id: r.verdict for r in uf.filter_urls(pages(spark, urls)).collect()}
    assert [found[400 + k] for k in range(40)] == ["allow"] * 20 + ["block"] * 20
