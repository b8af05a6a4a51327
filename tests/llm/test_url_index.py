"""URL rules against loops over every rule."""

import random

from strandloom.llm import url_rules

LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"


def fits(rule, url):
    """Character by character: ``^`` is one separator or an end, ``*`` any text, ``||`` a host or subdomain start."""
    if rule.startswith("||"):
        if "://" not in url or not url.split("://")[0].isalnum():
            return False
        at = url.index("://") + 3
        end = min([i for i in map(lambda c: url.find(c, at), "/?#") if i >= 0], default=len(url))
        return any(_from(rule[2:], url, i) for i in [at, *(i + 1 for i in range(at, end) if url[i] == ".")])
    return any(_from(rule, url, i) for i in range(len(url) + 1))


def _from(rule, url, i):
    if not rule:
        return True
    if rule[0] == "*":
        return any(_from(rule[1:], url, j) for j in range(i, len(url) + 1))
    if rule[0] == "^":
        return i == len(url) and _from(rule[1:], url, i) or i == 0 and _from(rule[1:], url, i) or i < len(url) and url[i] not in LETTERS and _from(rule[1:], url, i + 1)
    return i < len(url) and url[i] == rule[0] and _from(rule[1:], url, i + 1)


def test_index_against_every_rule(spark):
    r = random.Random(3)
    word = lambda: r.choice("abcd") + r.choice("xyz") + r.choice(["", "1", "22"])
    sep = lambda: r.choice("/.-?&=")
    url = lambda: r.choice(["http://", "https://", "HTTP://", ""]) + "".join(word() + sep() for _ in range(r.randint(1, 6))) + r.choice(["", word()])
    rule = lambda: r.choice(["@@", "", "", ""]) + r.choice(["||", "^", "", "*"]) + word() + r.choice(["^", "*", sep(), "^*^"]) + r.choice([word(), word() + "^", ""])
    rules = [rule() + sep() + word() + "^" for _ in range(3000)] + [rule() for _ in range(5)]
    hosts = {(f"{word()}.{word()}", f"/{word()}/"): r.choice(["allow", "block"]) for _ in range(300)} | {(word(), "/"): "block" for _ in range(4)}
    host_rules = [(v, *k) for k, v in hosts.items()]
    urls = [(i, url()) for i in range(100)] + [(-1, None), (-2, ""), (-3, "http://"), (-4, "http://ax.by/az/")]
    got = {x.page_id: x for x in url_rules.judge_urls(spark.createDataFrame(urls, "page_id long, url string"), host_rules=host_rules, pattern_rules=rules).collect()}
    for i, u in urls:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = rest.split("/")[0].split("?")[0].split("#")[0]
        path = rest[len(host) :].split("?")[0].split("#")[0]
        host = host.lower()
        found = max(((len(h + p), h, p) for h, p in hosts if ("." + host).endswith("." + h) and path.startswith(p)), default=None)
        low = (u or "").lower()
        if found:
            want = found[1] + found[2], hosts[found[1:]]
        else:
            hits = [x for x in rules if fits(x.removeprefix("@@"), low)]
            want = None, "allow" if any(x.startswith("@@") for x in hits) or not hits else "block"
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, *want), u
