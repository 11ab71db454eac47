"""License scan by diagonal voting of word k-grams against license templates.

* **Votes.** All rolling k-gram hashes of a text meet the templates' positions in a Spark join
  (the templates are a constant of the library, so that side is broadcast).  A match at word p
  of the text and word q of the template votes for the diagonal p - q; votes are counted per
  text, template and diagonal.
* **Merging.** Diagonals of a template at most ``drift`` apart (a fifth of its words, ``DRIFT`` at
  most) are one place: inserted or missing words move the diagonal a little.
* **Verification.** The words themselves are compared along every diagonal of a place.  The share
  of the template's words that stand there must reach ``SHARE`` hundredths, and all its numbers
  (versions) must.  A verified place that overlaps one of another template with more words (on
  equal words, an earlier template) gives way to it.
* **Base phrases** are looked up in the same pass and always count.

``score`` is the largest share of any place, or 0.5 where only a base phrase stands.

Defined cases: null or wordless text has no place, empty labels and score 0; a template that stands
twice gives two places and one label; rows repeated whole are scanned alike, their votes are
counted once; rows sharing a doc_id with different texts are separate; an empty table stays empty.
Only doc_id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barledger.llm import flat
from barledger.llm.common import NO_ID, doc_key, staged, text_or_empty

K = 4
SHARE, DRIFT = 75, 8
BASE_SCORE = 0.5

#: Phrases that always count, with their labels (fixed values).
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Public license notices, as (label, words); several notices may share a label (fixed values).
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc-4.0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the software",
    ),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
        "license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
        "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific language "
        "governing permissions and limitations under the license",
    ),
    (
        "gpl-3.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later "
        "version this program is distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for "
        "more details",
    ),
    (
        "bsd-2-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met 1 redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice "
        "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
        "distribution",
    ),
    (
        "bsd-3-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met 1 redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice "
        "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
        "distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at https mozilla org mpl 2 0",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
        "compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
        "commercial or non commercial and by any means",
    ),
]


@lru_cache(maxsize=1)
def _templates() -> tuple[list[list[bytes]], list[tuple[int, int, int]]]:
    """Words of each template; (k-gram hash, template, word place) of all its k-grams."""
    words = [text.encode().split() for _, text in TEMPLATES]
    grams = []
    for t, (_, text) in enumerate(TEMPLATES):
        body = np.frombuffer(text.encode(), np.uint8)
        grams += [(int(g), t, q) for q, g in enumerate(_grams(body, np.array([0, len(body)], np.int64))[0])]
    return words, grams


def drift(t: int) -> int:
    return min(DRIFT, len(TEMPLATES[t][1].split()) // 5)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """k-gram hashes of all rows in order, and the number of each row."""
    packed, s, e, row = flat.plain_words(data, offsets)
    whole = np.flatnonzero(row[K - 1 :] == row[: len(row) - K + 1]) if len(row) >= K else np.zeros(0, np.int64)
    grams = flat.span_hash(flat.prefix_hash(packed), s[whole], e[whole + K - 1]).view(np.int64)
    return grams, np.bincount(row[whole], minlength=len(offsets) - 1)


def _rolling(batches):
    """Per row: all its k-gram hashes, in order."""
    import pyarrow as pa

    for batch in batches:
        for a, b, data, off in flat.blocks(batch.column("text")):
            grams, n = _grams(data, off)
            ends = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(a, b - a) for c in ("d", "h", "row")), pa.ListArray.from_arrays(pa.array(ends), pa.array(grams))],
                names=["d", "h", "row", "grams"],
            )


def places(texts: DataFrame) -> DataFrame:
    """(d, h, wanted): per text its places (t, diagonals); ``texts`` has d, h, text."""
    spark: SparkSession = texts.sparkSession
    marks = spark.createDataFrame(_templates()[1], "gram bigint, t int, q int")
    sizes = spark.createDataFrame([(t, drift(t)) for t in range(len(TEMPLATES))], "t int, drift int")
    # Repeated rows vote apart first; their equal counts become one below.
    rows = texts.withColumn("row", F.monotonically_increasing_id())
    grams = rows.mapInArrow(_rolling, "d bigint, h bigint, row bigint, grams array<bigint>")
    grams = grams.select("d", "h", "row", F.posexplode("grams").alias("p", "gram"))
    votes = (
        grams.join(F.broadcast(marks), "gram")
        .groupBy("d", "h", "row", "t", (F.col("p") - F.col("q")).alias("diagonal"))
        .agg(F.count(F.lit(1)).alias("votes"))
        .groupBy("d", "h", "t", "diagonal")
        .agg(F.max("votes").alias("votes"))
    )
    walk = Window.partitionBy("d", "h", "t").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(walk) > F.col("drift"), F.lit(True))
    split = votes.join(F.broadcast(sizes), "t").withColumn("apart", apart.cast("int"))
    place = split.withColumn("place", F.sum("apart").over(walk)).groupBy("d", "h", "t", "place").agg(
        F.collect_list("diagonal").alias("diagonals"), F.sum("votes").alias("votes")
    )
    return place.groupBy("d", "h").agg(F.collect_list(F.struct("t", "diagonals", "votes")).alias("wanted"))


def verified(words: list[bytes], wanted: list[dict]) -> tuple[list[tuple[int, int, int, int]], float]:
    """Places (template, first word, end word, words that stand there) that hold, and the largest share."""
    found, best = [], 0.0
    for place in wanted:
        template = _templates()[0][place["t"]]
        seen: dict[int, int] = {}
        first, end = len(words), 0
        for diagonal in place["diagonals"]:
            lo, hi = max(0, -diagonal), min(len(template), len(words) - diagonal)
            for q in range(lo, hi):
                if words[q + diagonal] == template[q]:
                    seen[q] = 1
                    first, end = min(first, q + diagonal), max(end, q + diagonal + 1)
        best = max(best, len(seen) / len(template))
        numbers = all(q in seen for q, w in enumerate(template) if w.isdigit())
        if numbers and 100 * len(seen) >= SHARE * len(template):
            found.append((place["t"], first, end, len(seen)))
    found.sort(key=lambda x: (x[1], x[2], x[0]))
    beaten = set()
    for i, a in enumerate(found):
        for j in range(i + 1, len(found)):
            b = found[j]
            if b[1] >= a[2]:
                break
            if a[0] != b[0]:
                beaten.add(j if (a[3], -a[0]) > (b[3], -b[0]) else i)
    return [x for i, x in enumerate(found) if i not in beaten], best


_SCAN = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, spans array<struct<label: string, first: bigint, end: bigint, share: double>>"
)


def _scan(batches):
    import pyarrow as pa

    phrases = [(p.encode(), len(p.split()), label) for p, label in PHRASES.items()]
    keys = [int(flat.span_hash(flat.prefix_hash(np.frombuffer(p, np.uint8)), np.array([0]), np.array([len(p)]))[0]) for p, _, _ in phrases]
    kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))
    for batch in batches:
        for a, b, data, off in flat.blocks(batch.column("text")):
            packed, s, e, row = flat.plain_words(data, off)
            bounds = np.searchsorted(row, np.arange(b - a + 1))
            hashed = flat.prefix_hash(packed)
            at, of = [], []
            for x, ((phrase, n, _), key) in enumerate(zip(phrases, keys)):
                if len(s) < n:
                    continue
                hit = np.flatnonzero(flat.span_hash(hashed, s[: len(s) - n + 1], e[n - 1 :]) == np.uint64(key))
                hit = hit[row[hit] == row[hit + n - 1]]
                hit = np.array([i for i in hit if packed[s[i] : e[i + n - 1]].tobytes() == phrase], np.int64)
                at.append(hit)
                of.append(np.full(len(hit), x))
            at, of = (np.concatenate(at), np.concatenate(of)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            order = np.argsort(at, kind="stable")
            at, of = at[order], of[order]
            cut = np.searchsorted(row[at], np.arange(b - a + 1))
            wanted = batch.column("wanted").slice(a, b - a).to_pylist()
            out = []
            for i in range(b - a):
                mine = at[cut[i] : cut[i + 1]] - bounds[i]
                base = {phrases[x][2] for x in set(of[cut[i] : cut[i + 1]].tolist())}
                spans, score = [], 0.0
                if wanted[i]:
                    lo, hi = bounds[i], bounds[i + 1]
                    spans, score = verified(packed[s[lo] : e[hi - 1]].tobytes().split(b" "), wanted[i])
                spans = [{"label": TEMPLATES[t][0], "first": f, "end": z, "share": n / len(_templates()[0][t])} for t, f, z, n in spans]
                labels = base | {x["label"] for x in spans}
                ends = (int(mine[0]), int(mine[-1])) if len(mine) else (None, None)
                out.append((int(bounds[i + 1] - bounds[i]), len(mine), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), max(score, BASE_SCORE if base else 0.0), spans))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), kind]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column("d").slice(a, b - a), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names=names)


def scan(docs: DataFrame) -> DataFrame:
    """Labels, score and verified spans (words first to end) per row of ``docs``."""
    key = doc_key()
    texts = docs.select(key["d"].alias("d"), key["h"].alias("h"), text_or_empty().alias("text"))
    wanted = staged(places(texts))
    found = texts.join(wanted, ["d", "h"], "left").select("d", "text", "wanted").mapInArrow(_scan, _SCAN)
    return found.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans per document."""
    found = scan(docs).withColumn("n_spans", F.size("spans").cast("bigint"))
    return found.drop("spans")
