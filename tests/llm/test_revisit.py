"""op5 against a search through all captures."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from bidscope.llm.revisit import CAPTURES, PERMITTED, canonical_url, merged_headers, resolve_revisits

T0 = dt.datetime(2024, 1, 1)


def test_canonical_urls(spark):
    same = ["http://www.A.com/x/?b=2&a=1#top", "https://a.com:443/x?a=1&utm_source=q&b=2", "a.com/x/?a=1&b=2", " HTTP://A.com:80/x?b=2&a=1"]
    df = spark.createDataFrame([(u,) for u in same + ["a.com/X?a=1", "a.com", "", None]], "u string")
    got = [r[0] for r in df.select(canonical_url(F.col("u"))).collect()]
    assert got == ["a.com/x?a=1&b=2"] * 4 + ["a.com/X?a=1", "a.com", "", None]


def brute(rows):
    full = {}
    for c, key, t, status, h, body in rows:
        if status == 200 and body is not None and None not in (c, key, t):
            full.setdefault(key, []).append((t, c, {k.lower(): v for k, v in (h or {}).items()}, body))
    out = []
    for c, key, t, status, h, _ in rows:
        if status != 304:
            continue
        h = {k.lower(): v for k, v in (h or {}).items()}
        before = [f for f in full.get(key, []) if t is not None and c is not None and f[0] < t]
        if not before:
            out.append((c, None, "no_response", h, None))
            continue
        _, ref, stored, body = max(before, key=lambda f: f[:2])
        sha, verdict = hashlib.sha256(body.encode()).hexdigest(), "unverified"
        for name in ("etag", "last-modified"):
            if h.get(name) is not None and stored.get(name) is not None:
                verdict = "verified" if h[name].removeprefix("W/") == stored[name].removeprefix("W/") else "changed"
                break
        else:
            if "warc-payload-digest" in h:
                verdict = "verified" if h["warc-payload-digest"] == "sha256:" + sha else "changed"
        if verdict == "verified":
            h = stored | {k: v for k, v in h.items() if k in PERMITTED}
        out.append((c, ref, verdict, h, sha if verdict == "verified" else None))
    return out


def test_matches_brute_force(spark, rng):
    rows = []
    for c in range(900):
        key = "hot.com/a" if rng.random() < .4 else f"h{rng.randint(0, 40)}.com/p"
        t = T0 + dt.timedelta(minutes=rng.randint(0, 200))
        etag = f'"{rng.randint(0, 3)}"'
        h = rng.choice([{"ETag": etag}, {"etag": "W/" + etag, "Date": str(c)}, {"Last-Modified": f"m{rng.randint(0, 2)}"}, {},
                        {"WARC-Payload-Digest": "sha256:" + hashlib.sha256(b"p1").hexdigest()}, None])
        if h is not None:
            h = h | {"Content-Type": f"t{c}", "Cache-Control": f"c{c}"}
        if rng.random() < .5:
            rows.append((c, key, t, 200, h, rng.choice(["p1", "p2", ""])))
        else:
            rows.append((c, key, t, 304, h, None))
    rows += [(2000, None, T0, 304, None, None), (2001, "hot.com/a", None, 304, {}, None),
             (2002, "hot.com/a", T0 + dt.timedelta(days=9), 500, None, "x"), (None, "hot.com/a", T0, 200, None, "x")]
    df = spark.createDataFrame(rows, CAPTURES).repartition(5)
    got = {r["capture_id"]: (r["refers_to"], r["outcome"], r["headers"], r["payload_sha256"])
           for r in resolve_revisits(df).collect()}
    assert got == {r[0]: r[1:] for r in brute(rows)}
    assert {v[1] for v in got.values()} == {"verified", "changed", "unverified", "no_response"}


def test_repeats_and_empty_table(spark):
    rows = [(1, "a.com", T0, 200, {"ETag": "x", "etag": "y"}, "p")] * 2 + [(2, "a.com/", T0 + dt.timedelta(1), 304, {"ETAG": "x"}, None)] * 3
    df = spark.createDataFrame(rows, CAPTURES)
    got = resolve_revisits(df).collect()
    assert [(r["refers_to"], r["outcome"]) for r in got] == [(1, "verified")] * 3
    assert resolve_revisits(df.limit(0)).collect() == []


def test_only_permitted_headers_change(spark):
    df = spark.createDataFrame([({"etag": "1", "content-length": "9"}, {"etag": "2", "content-length": "0", "date": "d"})],
                               "s map<string,string>, f map<string,string>")
    assert df.select(merged_headers(F.col("s"), F.col("f"))).first()[0] == {"etag": "2", "content-length": "9", "date": "d"}
