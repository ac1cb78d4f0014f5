import random
import re
import time

from pyspark.sql import functions as F

from tidewater.llm import langid, urlfilter

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "v", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string, w0 int").repartition(3)


def plain(url):
    """host, path and rule as the definition says."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(r), r, kind) for kind, r in RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, *((max(fits)[1], max(fits)[2]) if fits else (None, None))


def test_rules_and_parts(spark):
    urls = [None, "", "no scheme/org/", "http://a.org", "http://a.org/", "HTTP://X.Example.ORG/es/1?q=/x#y", "https://example.org/en/12", "https://example.org/en/2", "https://notexample.org/es/", "http://sub.COM/fr/a", "http://q.com/de/", "http://q.com/De/", "ftp://b.net/p?x=http://c.org/", "x://É.org/ü", "http://org/", "http://torg/", "a\n://h.org/p\nq", "http://?x", "://a.org/en", "http://user@h.com:80/fr/x"]
    got = {r["page_id"]: r for r in urlfilter.judge(pages(spark, urls), RULES, spark.createDataFrame([], "canonical string")).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path, rule, verdict = plain(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict or "allow"), u


def test_list_has_no_false_positives_or_negatives(spark):
    rng = random.Random(1)
    urls = [f"https://h{rng.randrange(40)}.net/p/{rng.randrange(4000)}" for _ in range(3000)] + [None, None, "http://h1.net/p/1"] * 5
    listed = sorted({u.split("://")[1] for u in urls[:3000] if rng.random() < 0.3}) + [f"other{k}.net/x" for k in range(2000)]
    df = spark.createDataFrame([(u,) for u in [*listed, listed[0], None]], "canonical string")
    rows = pages(spark, urls).select("page_id", urlfilter.canonical(F.col("url")).alias("canonical"))
    got = {r["page_id"]: r["listed"] for r in urlfilter.on_list(rows, "canonical", df).collect()}
    assert got == {i: u is not None and u.split("://")[1] in set(listed) for i, u in enumerate(urls)}
    small = urlfilter.BROADCAST_BYTES
    try:
        urlfilter.BROADCAST_BYTES = 0  # the filter joined by shuffle
        again = {r["page_id"]: r["listed"] for r in urlfilter.on_list(rows, "canonical", df).collect()}
    finally:
        urlfilter.BROADCAST_BYTES = small
    assert again == got


def test_repeats_clashes_and_long_addresses(spark):
    long = "http://long.net/" + "p/" * 100_000
    urls = ["http://a.net/x", "http://a.net/x", long + "q", long + "r", "http://b.net/x"]
    rows = pages(spark, urls).select("page_id", urlfilter.canonical(F.col("url")).alias("canonical"), F.lit("c").alias("__block"), F.lit("c").alias("w0"), F.lit("c").alias("__hit"))
    names = spark.createDataFrame([("a.net/x",), ("a.net/x",), (long.split("://")[1] + "q",)], "canonical string")
    got = urlfilter.on_list(rows, "canonical", names)
    assert got.columns == [*rows.columns, "listed"]
    assert {r["page_id"]: (r["listed"], r["__block"], r["w0"]) for r in got.collect()} == {i: (i < 3, "c", "c") for i in range(5)}
    assert urlfilter.on_list(rows.limit(0), "canonical", names).count() == 0


def test_bloom_filter_passes_few_others(spark):
    names = spark.range(20_000).select(F.concat(F.lit("in"), F.col("id")).alias("k"))
    blocks = 20_000 // urlfilter.PER_BLOCK
    bloom = urlfilter.bloom_blocks(names, "k", blocks)
    asked = spark.range(20_000).select(F.concat(F.lit("out"), F.col("id")).alias("k")).withColumn("__block", urlfilter._block(F.col("k"), blocks)).join(bloom, "__block", "left")
    hit = F.lit(True)
    for i, bit in enumerate(urlfilter._bits(F.col("k"))):
        hit &= F.col(f"w{i}").bitwiseAND(bit) == bit
    assert asked.where(hit).count() < 20_000 * 0.02


def test_canonical(spark):
    urls = ["https://WWW.a.com:443/x.html?utm=1#t", "http://a.com/x/", "http://a.com/x", None, "none"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").coalesce(1).select(urlfilter.canonical(F.col("u"))).collect()]
    assert got == ["a.com/x", "a.com/x", "a.com/x", None, None]


WORDS = {"en": "the and with house river through wonder nothing", "de": "und nicht schön straße über zwischen ich", "fr": "être où façon garçon déjà leçon avec"}


def known(make_docs):
    rng = random.Random(2)
    return make_docs([(i, " ".join(rng.choices(WORDS[lang].split(), k=40)), lang, "s") for i, lang in enumerate(["en", "de", "fr"] * 60)])


def test_languages_of_pages(spark, make_docs):
    rng = random.Random(3)
    rows, want = [], []
    for i in range(300):
        lang = rng.choice(list(WORDS))
        said = lang if rng.random() < 0.9 else "en"
        body = " ".join(rng.choices(WORDS[lang].split(), k=rng.choice([0, 3, 30])))
        rows.append((i, f"http://{lang}{rng.randrange(3)}.site.{lang}/p", f'<html lang="{said}"><script>the and with</script><!-- the --><p>{body}</p></html>', "clash"))
        want.append(lang)
    df = spark.createDataFrame(rows, "page_id long, url string, html string, lang string").repartition(3)
    got = {r["page_id"]: r for r in langid.identify(df, known(make_docs)).collect()}
    assert len(got) == 300 and all(0 <= r["probability"] <= 1 + 1e-9 for r in got.values())
    assert sum(got[i]["lang"] == lang for i, lang in enumerate(want)) >= 290
    assert sum(got[i]["lang_by_text"] == lang for i, lang in enumerate(want)) < sum(got[i]["lang"] == lang for i, lang in enumerate(want))


def test_fusion_equals_plain_bayes(spark, make_docs):
    import numpy as np

    rows = [(0, "http://a.x.de/1", '<html lang="de">und</html>'), (1, "http://a.x.de/2", "<p>nicht</p>"), (2, "http://b.x.de/", '<html lang="en">the and</html>'), (3, None, None), (4, "http://c.fr/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = known(make_docs)
    langs, table = langid.learn_text(texts)
    temper, alpha = 20.0, 4.0
    logs = np.array([langid.trigrams(langid.visible((h or "").encode()).strip()) @ table.astype(np.float32).astype(float) / temper for _, _, h in rows])
    soft = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    p = np.array([soft(z) for z in logs])
    overall = (p.sum(axis=0) + alpha / 3) / (p.sum() + alpha)
    prior = lambda c, q: (c + alpha * q) / (c.sum() + alpha)
    hosts = [u.split("://")[1].split("/")[0] if u else None for _, u, _ in rows]
    said = ["de", None, "en", None, None]
    got = {r["page_id"]: r for r in langid.identify(df, texts, temper=temper, alpha=alpha).collect()}
    for i in range(5):
        q = overall
        if hosts[i]:
            for part in (hosts[i].split(".")[-1], ".".join(hosts[i].split(".")[-2:]), hosts[i]):
                mates = [j for j in range(5) if j != i and hosts[j] and (hosts[j] == part or hosts[j].endswith("." + part))]
                if part == hosts[i]:
                    mates = [j for j in mates if hosts[j] == part]
                q = prior(p[mates].sum(axis=0) if mates else np.zeros(3), q)
        else:
            q = overall
        f = np.zeros(3)
        if said[i]:
            mates = [j for j in range(5) if j != i and said[j] == said[i]]
            f = np.log(prior(p[mates].sum(axis=0) if mates else np.zeros(3), overall) / overall)
        post = soft(logs[i] + f + np.log(q))
        assert got[i]["lang"] == langs[int(post.argmax())]
        assert abs(got[i]["probability"] - post.max()) < 1e-4


def test_no_known_languages_and_empty(spark, make_docs):
    df = spark.createDataFrame([(0, "http://a.de/", "<p>x</p>")], "page_id long, url string, html string")
    one = langid.identify(df, known(make_docs).limit(0)).collect()
    assert len(one) == 1 and one[0]["lang"] is None and one[0]["probability"] == 0
    assert langid.identify(df.limit(0), known(make_docs)).count() == 0


def test_language_declared_after_long_preambles(spark, make_docs):
    pages = ["<!-- " + "licence " * 1000 + '<html lang="en"> --><html lang="de">', " " * 9000 + "<html lang='fr'>", "<script>s = '<html lang=en>'</script>" + "<?x " + "y " * 5000 + "?>" + "<html class=a lang=de>", "<html><p>" + "z " * 5000]
    df = spark.createDataFrame([(i, "http://a.org/", t) for i, t in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r["declared"] for r in langid.identify(df, known(make_docs)).collect()}
    assert got == {0: "de", 1: "fr", 2: "de", 3: None}


def test_broken_markup_is_read_in_linear_time():
    """Against the patterns that define it, and on pages that never close what they open."""
    skip = re.compile(rb"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)
    rng = random.Random(5)
    bits = [b"<script>", b"</script >", b"<SCRIPT x", b"<style>", b"</style>", b"<!--", b"-->", b"<p>", b"</p>", b"text", b" <", b">", b"<html lang='de'>", b"<scripted>", b"</script", b"\n"]
    for _ in range(3000):
        html = b"".join(rng.choices(bits, k=rng.randrange(0, 14)))
        assert langid.visible(html) == skip.sub(b" ", html), html
    began = time.monotonic()
    for opened in (b"<script>x", b"<!-- x", b"<", b"<html ", b"<style ", b"</script ", b"<script></script x"):
        langid.parse(opened * (1_000_000 // len(opened)))
    assert time.monotonic() - began < 15
    assert langid.declared(b"<html lang=de") == "de" and langid.declared(b"<p>" * 300_000 + b"<html lang=fr>") == "fr"


def test_domains_below_country_registries(spark):
    hosts = ["a.b.co.uk", "b.co.uk", "a.example.org", "org", "x.com.de", "shop.x.com"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string").select(F.regexp_extract("host", langid.DOMAIN, 1))
    assert [r[0] for r in df.collect()] == ["b.co.uk", "b.co.uk", "example.org", "", "x.com.de", "x.com"]
