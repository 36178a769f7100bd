import re

from tidemark.llm.queries import URL_RULES
from tidemark.llm.url_templates import UrlRule, filter_urls, template_table

SCHEMA = "page_id long, url string, host string, shape string, label string"


def judge(spark, urls, rules=URL_RULES, label=None):
    rows = [(i, u, "clash", "clash", x) for i, (u, x) in enumerate(urls)]
    out = filter_urls(spark.createDataFrame(rows, SCHEMA), rules, label=label)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def test_parts_and_rules_against_brute_force(spark):
    urls = [
        "https://A.Example.NET/en/1", "http://example.net/en", "http://net/", "http://net", "x://notexample.com/de/", "http://m.example.com/de/7?x=/fr/",
        "http://a.b.org/fr/#x", "org/fr/", "://org/fr/x", "http://a?b/c", "http://É.org/fr/\nq", "a://b://net/x", "", None, "http://x.org/fr/1", "http://x.org/fr/1",
        "http://h.test/" + "seg/" * 50_000,
    ]
    got = judge(spark, [(u, None) for u in urls])
    for i, u in enumerate(urls):
        host, path = parts(u)
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.name), default=None)
        assert got[i] == (host, path, rule and rule.name, rule.verdict if rule else "allow"), u


def test_rejects_what_shares_a_template_with_blocked_urls(spark):
    # /u/<name> has rare children, so they merge; most labelled ones are blocked.
    rules = tuple(UrlRule("bad.test", f"/u/name{c}", "block") for c in "abcdefghijklmnop")
    urls = [(f"http://bad.test/u/name{c}/p{i}", None) for c in "abcdefghijklmnop" for i in range(2)]
    urls += [("http://bad.test/u/zed/p9", None)] + [(f"http://bad.test/docs/page/{i}", None) for i in range(40)]
    got = judge(spark, urls, rules)
    assert got[32] == ("bad.test", "/u/zed/p9", None, "block")
    assert all(got[i][3] == "allow" for i in range(33, 73))  # a literal branch of its own


def test_caller_labels_and_smoothing(spark):
    few = [(f"http://h.test/x/{i}", "block") for i in range(2)] + [("http://h.test/x/9", None)]
    assert judge(spark, few, (), "label")[2][3] == "allow"  # two labels do not outweigh the prior
    many = [(f"http://h.test/x/{i}", "block") for i in range(30)] + [("http://h.test/x/99", None)]
    assert judge(spark, many, (), "label")[30][3] == "block"


def test_similar_branches_merge_and_unlike_ones_stay(spark):
    rows = [("h", [lang, "<n>"], None) for lang in ("en", "fr", "de") for _ in range(50)]
    rows += [("h", ["shop", "cart", "x"], None)] * 50
    table = template_table(spark.createDataFrame(rows, "host string, shape array<string>, label string"))
    got = {(tuple(r["shape"]), r.template) for r in table.select("shape", "template").collect()}
    merged = {t.split("/")[1] for s, t in got if s[0] in ("en", "fr", "de")}
    assert merged == {"*(<n>)"}
    assert [t.split("/")[1] for s, t in got if s[0] == "shop"] == ["shop"]


def test_a_branch_with_other_labels_stays_apart(spark):
    rows = [("h", [lang, "<n>"], "block" if lang == "de" else None) for lang in ("en", "fr", "de") for _ in range(50)]
    table = template_table(spark.createDataFrame(rows, "host string, shape array<string>, label string"))
    got = {r["shape"][0]: (r.template.split("/")[1], r.rejected) for r in table.collect()}
    assert got == {"en": ("*(<n>)", False), "fr": ("*(<n>)", False), "de": ("de", True)}


def test_an_unlabelled_branch_takes_the_verdict_of_its_siblings(spark):
    """Nineteen of twenty branches alike are blocked by rule: so is the twentieth, but not one that is labelled allow."""
    names = [f"branch{c}" for c in "abcdefghijklmnopqrst"]
    rules = tuple(UrlRule("h.test", f"/{n}/", "block") for n in names[:19])
    urls = [(f"http://h.test/{n}/item/{i}", None) for n in names for i in range(10)]
    urls += [(f"http://h.test/fine/item/{i}", "allow" if i < 8 else None) for i in range(10)]
    urls += [(f"http://other.test/{n}/item/{i}", None) for n in names for i in range(10)]
    got = judge(spark, urls, rules, "label")
    by = {}
    for host, path, _, verdict in got.values():
        by.setdefault((host, path.split("/")[1]), set()).add(verdict)
    assert by == {("h.test", n): {"block"} for n in names} | {("h.test", "fine"): {"allow"}} | {("other.test", n): {"allow"} for n in names}


def test_one_labelled_branch_does_not_decide_for_many(spark):
    urls = [(f"http://h.test/{lang}/item/{i}", None) for lang in ("en", "fr", "es", "de") for i in range(40)]
    got = judge(spark, urls, (UrlRule("h.test", "/de/", "block"),))
    assert all(verdict == ("block" if path.startswith("/de/") else "allow") for _, path, _, verdict in got.values())


def test_empty_table_and_native_plan(spark):
    assert judge(spark, []) == {}
    df = filter_urls(spark.createDataFrame([(1, "http://a.test/b", "", "", None)], SCHEMA), URL_RULES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
