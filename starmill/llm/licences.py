"""Licences of files: notices matched to templates, and inheritance from directories.

Column expressions only. Sentences that speak of licensing are compared with short
notice templates by the cosine of TF-IDF vectors; inverse document frequencies are counted
over all such sentences and the templates. Files that hold such a sentence are also compared
whole with the licence texts, in the same way. A file alike to one of those, or mostly made
of notices, is a licence file and declares its licence for its directory. A file without a notice inherits
from the nearest directory above it that declares one.
"""

from __future__ import annotations

from importlib.resources import files as resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.rules import bind, words_of
from starmill.operators.lookups import join_large
from starmill.sources.scratch import written

MIN_SCORE = 0.55
MIN_WHOLE = 0.8  # of a whole file with a licence text, to be a licence file
FILE_SHARE = 0.5  # of a file's words in licence sentences, to be a licence file

# Licence identifiers and the sentences by which they are usually named.
TEMPLATES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
_MARKS = r"(?i)licen[cs]e|public domain|creative commons|permission is hereby|permission to use|redistribution and use"
_STOP = r"(?<=[.!?;])\s+(?=[\p{Lu}*/#])"
_SENTENCE = r"\n|" + _STOP
# Between blocks are lines without a letter or digit, as ' *' in a comment.
_WRAPPED = r"\n[^\p{L}\p{N}\n]*(?=\n)|" + _STOP


def licence_sentences(text: Column) -> Column:
    """Sentences of a text that speak of licensing; whole texts are searched. A sentence
    that is wrapped over lines is listed whole, after the lines that speak of licensing."""
    lines = F.filter(F.split(text, _SENTENCE), lambda s: s.rlike(_MARKS))
    wrapped = F.filter(F.split(text, _WRAPPED), lambda s: s.rlike(_MARKS) & s.contains("\n"))
    return F.when(text.rlike(_MARKS), F.concat(lines, wrapped)).otherwise(F.array().cast("array<string>"))


def licence_words(sentence: Column) -> Column:
    return F.regexp_extract_all(F.lower(sentence), F.lit(r"([\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*)"))


def _templates(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(i).alias("template"), F.lit(n).alias("licence"), F.lit(t).alias("sentence"))
            for i, (n, t) in enumerate(TEMPLATES)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _term_counts(sentences: DataFrame, key: str) -> DataFrame:
    """(key, word, tf) of sentences; a sentence's words are counted within its row."""

    def counted(words: Column) -> Column:
        # Words in order, so that a word's count is the stretch to where the next begins.
        def runs(at: Column, ordered: Column) -> Column:
            return F.transform(
                at,
                lambda i, n: F.struct(
                    F.get(ordered, i).alias("word"),
                    (F.coalesce(F.get(at, n + 1), F.size(ordered)) - i).alias("tf"),
                ),
            )

        def starts(ordered: Column) -> Column:
            first = F.filter(
                F.transform(
                    ordered,
                    lambda w, i: F.when((i == 0) | (w != F.get(ordered, i - 1)), i),
                ),
                lambda i: i.isNotNull(),
            )
            return bind(first, lambda at: runs(at, ordered))

        return bind(F.array_sort(words), starts)

    return sentences.select(key, F.inline(bind(licence_words(F.col("sentence")), counted)))


def match_sentences(sentences: DataFrame, how_often: str = "n") -> DataFrame:
    """(sentence, licence, score): the nearest template of each distinct sentence.

    ``how_often`` counts a sentence's occurrences, so that frequencies are those of the
    whole corpus although each distinct sentence is compared once.
    """
    spark = sentences.sparkSession
    templates = _templates(spark)
    # A sentence may be very long, so its words carry a number of 128 bits instead of it.
    named = sentences.select(F.md5("sentence").alias("id"), "sentence", F.col(how_often).alias("n"))
    terms = written(_term_counts(named.select("id", "sentence"), "id"), "licence_terms")
    of_templates = _term_counts(templates, "template")
    seen = terms.join(named.select("id", "n"), "id").select("word", "n").unionByName(
        of_templates.select("word", F.lit(1).cast("bigint").alias("n"))
    )
    frequency = seen.groupBy("word").agg(F.sum("n").alias("df"))
    every = named.agg((F.coalesce(F.sum("n"), F.lit(0)) + len(TEMPLATES)).alias("every"))
    idf = frequency.join(F.broadcast(every)).select(
        "word", (F.log((1 + F.col("every")) / (1 + F.col("df"))) + 1).alias("idf")
    )
    idf = written(idf, "licence_idf")
    weight = (1 + F.log("tf")) * F.col("idf")
    weighed = written(terms.join(idf, "word").select("id", "word", weight.alias("w")), "licence_weights")
    rows = of_templates.join(idf, "word").select("template", "word", weight.alias("v"))
    lengths = rows.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"))
    # As many rows as the templates have words.
    rows = F.broadcast(rows.join(lengths, "template").join(templates.select("template", "licence"), "template"))
    dots = (
        weighed.join(rows, "word")
        .groupBy("id", "template", "licence", "length")
        .agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    )
    norms = weighed.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    scored = dots.join(norms, "id").select(
        "id", "licence", (F.col("dot") / (F.col("norm") * F.col("length"))).alias("score")
    )
    best = scored.groupBy("id").agg(F.max(F.struct("score", "licence")).alias("best"))
    return best.join(named.select("id", "sentence"), "id").select("sentence", "best.licence", "best.score")


def _licence_texts(spark: SparkSession) -> DataFrame:
    """(licence, text) of the whole licence texts beside this module."""
    named = sorted((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in resources(__package__).joinpath("licence_texts").iterdir())
    rows = [F.struct(F.lit(n).alias("licence"), F.lit(t).alias("text")) for n, t in named]
    return spark.range(1).select(F.inline(F.array(*rows)))


def match_files(marked: DataFrame) -> DataFrame:
    """(row, whole_licence, whole_score) of (row, text): the licence text nearest to each
    whole file, where it is at least as near as ``MIN_WHOLE``."""

    def counted(texts: DataFrame, key: str) -> DataFrame:
        return texts.select(key, F.explode(licence_words(F.col("text"))).alias("word")).groupBy(key, "word").agg(
            (1 + F.log(F.count("*"))).alias("tf")
        )

    texts = written(counted(_licence_texts(marked.sparkSession), "licence"), "licence_texts")
    terms = written(counted(marked, "row"), "file_terms")
    every = marked.count() + texts.select("licence").distinct().count()
    frequency = terms.select("word").unionByName(texts.select("word")).groupBy("word").agg(F.count("*").alias("df"))
    idf = written(frequency.select("word", (F.log((1 + every) / (1 + F.col("df"))) + 1).alias("idf")), "file_idf")
    own = texts.join(idf, "word").select("licence", "word", (F.col("tf") * F.col("idf")).alias("v"))
    lengths = own.groupBy("licence").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length"))
    # As many rows as the licence texts have words: per word, the licences and weights.
    own = own.join(lengths, "licence").groupBy("word").agg(
        F.collect_list(F.struct("licence", (F.col("v") / F.col("length")).alias("v"))).alias("of")
    )
    weighed = terms.join(idf, "word").select("row", "word", (F.col("tf") * F.col("idf")).alias("w"))
    weighed = written(weighed, "file_weights")
    norms = weighed.groupBy("row").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(F.broadcast(own), "word").select("row", "w", F.inline("of")).groupBy("row", "licence").agg(
        F.sum(F.col("w") * F.col("v")).alias("dot")
    )
    scored = dots.join(norms, "row").select("row", "licence", (F.col("dot") / F.col("norm")).alias("score"))
    best = scored.groupBy("row").agg(F.max(F.struct("score", "licence")).alias("best"))
    return best.filter(F.col("best.score") >= MIN_WHOLE).select(
        "row", F.col("best.licence").alias("whole_licence"), F.col("best.score").alias("whole_score")
    )


def ancestors(directory: Column) -> Column:
    """A directory and those above it, nearest first, '' (the root) last."""

    def each(parts: Column) -> Column:
        return F.transform(
            F.sequence(F.size(parts), F.lit(0), F.lit(-1)),
            lambda k: F.array_join(F.slice(parts, 1, k), "/"),
        )

    return bind(F.filter(F.split(directory, "/"), lambda p: p != ""), each)


def scan(files: DataFrame, path: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``files``: doc_id, path, own_licence, own_score, licence_file, licence,
    declared_in.

    ``path`` gives the file's path from '/'-separated names; a null path is a file in the
    root. ``own_licence`` is the licence text that the whole file is alike to with a cosine of
    at least 0.8, or else the best match of its notices with a cosine of at least 0.55, ties
    to the later name. ``licence`` is that, or else the licence of the nearest
    directory that declares one (its licence files' most frequent, ties to the earlier
    name), named in ``declared_in``. Both are null without any. Null and empty texts have
    no notice; repeated rows are judged alike.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    rows = files.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.coalesce(path, F.lit("")).alias("path"),
        licence_sentences(text).alias("sentences"),
        F.size(words_of(text)).alias("n_words"),
        F.when(text.rlike(_MARKS), text).alias("text"),
    )
    narrow = written(rows.withColumn("row", F.monotonically_increasing_id()), "notices")
    notices = narrow.filter("size(sentences) > 0").select("row", F.explode("sentences").alias("sentence"))
    distinct = written(notices.groupBy("sentence").agg(F.count("*").alias("n")), "sentences")
    matched = match_sentences(distinct).filter(F.col("score") >= MIN_SCORE)
    found = notices.join(matched, "sentence").groupBy("row").agg(
        F.max(F.struct("score", "licence")).alias("best"),
        # Wrapped sentences repeat words of their lines.
        F.greatest(
            F.sum(F.when(F.col("sentence").contains("\n"), 0).otherwise(F.size(words_of(F.col("sentence"))))),
            F.sum(F.when(F.col("sentence").contains("\n"), F.size(words_of(F.col("sentence")))).otherwise(0)),
        ).alias("notice_words"),
    )
    whole = match_files(narrow.filter("text IS NOT NULL").select("row", "text"))
    judged = narrow.drop("text").join(found.join(whole, "row", "full"), "row", "left").select(
        "doc_id",
        "path",
        F.regexp_replace("path", r"/*[^/]*$", "").alias("directory"),
        F.coalesce("whole_licence", "best.licence").alias("own_licence"),
        F.coalesce("whole_score", "best.score").alias("own_score"),
        (F.col("whole_licence").isNotNull() | (F.coalesce("notice_words", F.lit(0)) >= FILE_SHARE * F.greatest("n_words", F.lit(1)))).alias("licence_file"),
    )
    judged = written(judged, "judged")

    votes = judged.filter("licence_file").groupBy("directory", "own_licence").agg(F.count("*").alias("n"))
    declared = votes.groupBy("directory").agg(
        F.min(F.struct((-F.col("n")).alias("n"), F.col("own_licence").alias("licence"))).alias("top")
    )
    clean = F.element_at(ancestors(F.col("directory")), 1)
    declared = declared.select(clean.alias("above"), F.col("top.licence").alias("declared"), F.col("top.n").alias("n"))
    declared = declared.groupBy("above").agg(F.min(F.struct("n", "declared")).alias("top"))
    declared = declared.select("above", "top.declared")
    # Directories are resolved once each, not once per file.
    climbed = judged.select("directory").distinct().select(
        "directory", F.posexplode(ancestors(F.col("directory"))).alias("distance", "above")
    )
    nearest = climbed.join(declared, "above").groupBy("directory").agg(
        F.min(F.struct("distance", "above", "declared")).alias("near")
    )
    # A directory may hold a third of all files; its files are spread.
    joined = join_large(judged, nearest, "directory", "directory", ["doc_id", "path"])
    return joined.select(
        "doc_id",
        "path",
        "own_licence",
        "own_score",
        "licence_file",
        F.coalesce("own_licence", F.col("near.declared")).alias("licence"),
        F.when(F.col("own_licence").isNull(), F.col("near.above")).alias("declared_in"),
    )
