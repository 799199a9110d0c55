"""License scans by a positional rare-token index, in DataFrame expressions only.

The index holds every template (short phrases and notices) as postings ``word -> (template, position)``. Each word's
document frequency is counted over all documents; the rarest words of a template are its anchors. In a text only
places of anchor words are looked at: each posting of the word there votes for the start ``place - position``, starts where
all anchors of a phrase (or most of a notice's) meet are candidates, and a candidate counts when the template's key
phrase stands word for word at its place.

Defined results: null is the empty text; a text without words or templates has null places, empty labels and score 0. Very long texts are read whole; of equally rare words the
first in order are anchors; repeated rows have results of their own; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.fingerprint import let

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Opening words of public license notices: label, notice, key phrase in it
NOTICES = [
    ("mit-permission", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     "permission is hereby granted free of charge"),
    ("mit-notice", "released under the mit license", "released under the mit license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-later", "you can redistribute it and or modify it under the terms of the gnu general public license", "under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "permission to use copy modify and or distribute this software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("cc-by", "licensed under a creative commons attribution", "creative commons attribution"),
]


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool

    @property
    def key_at(self) -> int:
        return next(i for i in range(len(self.words)) if self.words[i: i + len(self.key)] == self.key)


def templates() -> list[Template]:
    base = [Template(label, tuple(p.split()), tuple(p.split()), True) for p, label in BASE.items()]
    return base + [Template(label, tuple(t.split()), tuple(k.split()), False) for label, t, k in NOTICES]


def words(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), F.lit(WORD), F.lit(0))


def frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Documents, and those with each word of the templates; bounded by the templates."""
    held = F.array_intersect(words(F.col("text")), F.array(*[F.lit(w) for w in vocabulary]))
    got = docs.select(F.explode_outer(held).alias("w")).groupBy("w").count().collect()
    return docs.count(), {r["w"]: r["count"] for r in got if r["w"] is not None}


def scan(docs: DataFrame, anchors: int = 3) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places)``.

    ``places`` lists ``(label, start)`` of all templates found; ``score`` is the largest share of a found
    template's idf that its words cover where it stands. ``anchors`` rarest words of a template are looked up.
    """
    known = templates()
    vocabulary = sorted({w for t in known for w in t.words})
    n, df = frequencies(docs, vocabulary)
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1e-3 for w in vocabulary}
    postings: dict[str, list[tuple[int, int]]] = {}
    need: list[int] = []
    for t, template in enumerate(known):
        # anchors stand in the key phrase, which every place must have
        span = range(template.key_at, template.key_at + len(template.key))
        rare = sorted(span, key=lambda i: (-idf[template.words[i]], i))[:anchors]
        need.append(len(rare))
        for i in rare:
            postings.setdefault(template.words[i], []).append((t, i))
    looked = F.create_map(*[x for w, at in sorted(postings.items()) for x in (
        F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("i")) for t, i in at]))])
    needed = F.array(*[F.lit(k) for k in need])
    keys = F.array(*[F.array(*[F.lit(w) for w in t.key]) for t in known])
    key_at = F.array(*[F.lit(t.key_at) for t in known])
    full = F.array(*[F.array(*[F.lit(w) for w in t.words]) for t in known])
    weights = F.array(*[F.array(*[F.lit(idf[w]) for w in t.words]) for t in known])
    labels = F.array(*[F.lit(t.label) for t in known])
    base = F.array(*[F.lit(t.base) for t in known])
    rare_words = sorted(postings)

    def starts(w: Column) -> Column:
        """Sorted ``(template, start)`` votes that all anchors share, each once."""
        spots = F.filter(F.transform(w, lambda x, i: F.when(x.isin(rare_words), F.struct(x.alias("x"), i.alias("i")))), lambda s: s.isNotNull())
        votes = F.flatten(F.transform(spots, lambda s: F.transform(looked[s["x"]], lambda p: F.struct(p["t"].alias("t"), (s["i"] - p["i"]).alias("at")))))
        # equal votes lie next to each other: a start has enough of them if the one needed places further on is equal
        return let(F.array_sort(votes), lambda v: F.filter(v, lambda x, i: (
            (F.get(v, i + F.get(needed, x["t"]) - 1) == x) & ((i == 0) | (F.get(v, i - 1) != x)))))

    def verified(w: Column, found: Column) -> Column:
        return F.filter(found, lambda x: (x["at"] + F.get(key_at, x["t"]) >= 0) & (F.slice(
            w, x["at"] + F.get(key_at, x["t"]) + 1, F.size(F.get(keys, x["t"]))) == F.get(keys, x["t"])))

    def covered(w: Column, x: Column) -> Column:
        """Share of the template's idf whose words stand at their places."""
        return F.aggregate(F.zip_with(F.get(full, x["t"]), F.sequence(x["at"], x["at"] + F.size(F.get(full, x["t"])) - 1), lambda a, i: F.coalesce(
            F.when(i >= 0, F.get(w, i) == a), F.lit(False))), F.struct(F.lit(0).alias("k"), F.lit(0.0).alias("s")), lambda acc, hit: F.struct(
                (acc["k"] + 1).alias("k"), (acc["s"] + F.when(hit, F.get(F.get(weights, x["t"]), acc["k"])).otherwise(0.0)).alias("s")),
            lambda acc: acc["s"]) / F.aggregate(F.get(weights, x["t"]), F.lit(0.0), lambda s, y: s + y)

    def found(w: Column) -> Column:
        places = verified(w, starts(w))
        return let(places, lambda p: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.transform(p, lambda x: F.struct(F.get(labels, x["t"]).alias("label"), x["at"].cast("long").alias("start"), F.get(base, x["t"]).alias("base"))).alias("places"),
            F.coalesce(F.array_max(F.transform(p, lambda x: covered(w, x))), F.lit(0.0)).alias("score")))

    got = docs.select("doc_id", let(words(F.col("text")), found).alias("r")).select("doc_id", "r.*")
    plain = F.filter("places", lambda x: x["base"])
    at = F.transform(plain, lambda x: x["start"])

    def joined(places) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))), ",")

    return got.select(
        "doc_id", "n_words", F.size(plain).cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        joined(plain).alias("base_labels"), joined("places").alias("labels"), F.least("score", F.lit(1.0)).alias("score"), "places")
