import random
import re

from pyspark.sql import functions as F

from lexmill.llm import line_quality as L


def test_hints_spare_no_line_that_the_patterns_fail(spark):
    """Rules written out with plain regexes against the shortened ones."""
    rng = random.Random(5)
    parts = ["All Rights Reserved", "terms of use", "TERMS OF service", "privacy policy", "cookies", "Cookie policy", "enable javascript", "lorem ipsum", "log in", "Sign In", "sign up", "subscribe", "newsletter", "read more", "click here", "back to top", "skip to content", "skip to main content", "share this", "share on", "follow us", "powered by", "copyright", "licensed under", "released under the", "released under a", "cookie", "a", "b.", "!", "?!#", "|", "| > |", "words", "…”", "\r", "\t", "end.\")", "»"]
    lines = parts + [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(800)]
    lines = [x for x in lines if re.search(r"[^\x20\x09-\x0D]", x)]

    def passes(x):
        n, marks, menu = len(re.findall(r"[^\x20\x09-\x0D]+", x)), len(re.findall(r"[!?#*$%&<>]", x)), len(re.findall("[|\xbb•\xb7>]", x))
        ends = re.search("[.!?:;…。][\"'”’\xbb)\\]]*[\x20\x09-\x0d]*\\Z", x)
        boiler = re.search(L.BOILERPLATE.replace("(?i)", ""), x, re.I | re.A)
        return bool((ends or n > 4) and marks < 0.8 * n and not (menu >= 3 and menu >= 0.25 * n) and not boiler)

    # every alternative of the pattern is met, so one without a hint would be seen
    assert all(any(h in x.lower() for x in parts) for h in L.HINTS)
    rows = spark.createDataFrame([(x,) for x in lines], "x string").select("x", F.transform(F.array("x"), lambda x: L.line_passes(x))[0].alias("p")).collect()
    assert {r["x"]: r["p"] for r in rows} == {x: passes(x) for x in lines}
