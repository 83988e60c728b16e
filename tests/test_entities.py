"""Character references against the standard library."""

import html
import random

from tessera.operators import pages


def test_references_as_the_standard_library_reads_them(spark):
    rng = random.Random(7)
    names = sorted(html.entities.html5)
    texts = [f"&{n}" for n in names] + [f"a&{n.rstrip(';')}b; c" for n in names[::3]]
    texts += [f"&#{n};" for n in [*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 10**9, 10**20]]
    texts += [f"&#{x}{n:x}" for n in (0, 9, 65, 0x80, 0x9F, 0x20AC, 0xD800, 0x1F600, 0x110000, 0xFFFFFFFF) for x in "xX"]
    texts += ["&", "&&", "&#", "&#;", "&#x;", "&#xg;", "&;", "& amp;", "&amp&lt", "&notit; &notin; &not", "&#0065;&#x000041;", "no reference", "", "&" + "a" * 40 + ";", "&AMP;&ampamp;", "&#38;lt;"]
    parts = ["&", "#", "x", "amp", ";", "lt", "not", "in", "12", "8364", " ", "é", "copy", "\n", "<"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(500)]
    frame = spark.createDataFrame(list(enumerate(texts)), "ix int, t string")
    got = {r.ix: r.u for r in frame.select("ix", pages.unescape(frame.t).alias("u")).collect()}
    wrong = [(t, got[i], html.unescape(t)) for i, t in enumerate(texts) if got[i] != html.unescape(t)]
    assert not wrong
    assert frame.select(pages.unescape(frame.t.cast("string"))).count() == len(texts)
