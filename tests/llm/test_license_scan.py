import random

from tidemark.llm.license_scan import TEMPLATES, scan


def test_planted_notices_are_found_and_clean_texts_left_alone(spark):
    rnd = random.Random(1)
    words = lambda n: " ".join(rnd.choice(["er", "on", "thing", "license", "under", "the"]) for _ in range(n))
    names = sorted(TEMPLATES)
    rows = [(i, f"{words(rnd.randint(0, 40))}\n{TEMPLATES[names[i % len(names)]].upper()} {words(30)}") for i in range(200)]
    rows += [(1000 + i, words(100)) for i in range(50)] + [(2000, None), (2001, ""), (2002, "MIT License"), (0, rows[0][1])]
    got = {}
    for r in scan(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect():
        got[r.doc_id] = r.licenses
        assert r.n_licenses == len(r.licenses)
    found = sum(names[i % len(names)] in got[i] for i in range(200))
    assert found >= 0.97 * 200  # 0.99 of the shortest notices are expected
    assert all(not got[i] for i in got if i >= 1000)
    assert scan(spark.createDataFrame([], "doc_id long, text string"), ["doc_id"]).collect() == []


def test_one_shingle_notices_are_met_anywhere(spark):
    notice = TEMPLATES["MIT"]
    filler = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    rows = [(i, f"{notice} {filler(i, 30)}") for i in range(2000)]
    rows += [(10_000 + i, f"{filler(i, 30)} {notice} {filler(-i, 30)}") for i in range(2000)] + [(20_000 + i, f"{filler(i, 30)} {notice}") for i in range(500)]
    got = {r.doc_id: r.licenses for r in scan(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    at = lambda a, b: sum(got[i] == ["MIT"] for i in range(a, b))
    assert at(0, 2000) == 2000 and at(20_000, 20_500) == 500  # certain at the ends
    assert at(10_000, 12_000) >= 0.998 * 2000  # 0.99985 expected


MIT = """The MIT License (MIT)

Copyright (c) 2024 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
ISC = """Copyright 2024 A. Person

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE."""
BSD = """Copyright 2024 A. Person

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
CLAUSE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"


def test_whole_license_texts(spark):
    rows = [(0, MIT), (1, ISC), (2, BSD), (3, BSD + CLAUSE), (4, ISC.replace(",\nprovided that the above copyright notice and this permission notice appear in all copies", ""))]
    got = {r.doc_id: r.licenses for r in scan(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    assert got == {0: ["MIT-text"], 1: ["ISC-text"], 2: ["BSD-2-Clause"], 3: ["BSD-2-Clause", "BSD-3-Clause"], 4: []}
