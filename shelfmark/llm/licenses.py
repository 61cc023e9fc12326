"""License scans: the digest of a canonical text, looked up among digests of known licences.

Copyright lines go, letters become small, spellings of one word become one, and
everything that is not a letter or a digit becomes one space. Two texts that differ
only in these respects have the same digest. Whole texts are looked up, and so is each
line by itself, since a notice is most often one line of a longer text.

Only built-in functions are used. The known texts are a table; its digests are made
by the same expression, and the lookup is a hash join by digest. The licences of ``TEXTS``
are found by their whole texts and by notices, the others of ``NAMES`` by notices only,
unless ``known_digests`` is given rows with their texts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import without

# Spellings and the one that stands for them, applied in this order to small letters.
SPELLINGS = (
    ("licence", "license"), ("licensed", "license"), ("released", "license"), ("distributed", "license"),
    ("gnu general public license", "gpl"), ("gnu gpl", "gpl"), ("creative commons attribution", "cc by"),
    ("noncommercial", "nc"), ("non commercial", "nc"), ("sharealike", "sa"), ("share alike", "sa"),
    ("noninfringement", "non infringement"), ("merchantibility", "merchantability"), ("sub license", "sublicense"),
    ("version ", "v"), ("favour", "favor"), ("behaviour", "behavior"), ("https ", "http "),
)

# Names of licences by SPDX identifier.
NAMES = {
    "MIT": "MIT License", "Apache-2.0": "Apache License, Version 2.0", "ISC": "ISC License",
    "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License", "MPL-2.0": "Mozilla Public License, Version 2.0",
    "GPL-2.0": "GNU General Public License, version 2", "GPL-3.0": "GNU General Public License, version 3",
    "LGPL-3.0": "GNU Lesser General Public License, version 3", "AGPL-3.0": "GNU Affero General Public License, version 3",
    "CC-BY-4.0": "CC BY 4.0", "CC-BY-SA-4.0": "CC BY-SA 4.0", "CC-BY-NC-4.0": "CC BY-NC 4.0", "CC-BY-ND-4.0": "CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0": "CC BY-NC-SA 4.0", "CC-BY-NC-ND-4.0": "CC BY-NC-ND 4.0", "CC0-1.0": "CC0 1.0", "Zlib": "zlib License",
    "Unlicense": "Unlicense", "BSL-1.0": "Boost Software License, Version 1.0", "EPL-2.0": "Eclipse Public License, Version 2.0",
}
# The sentences in which a name is a notice.
NOTICES = ("Licensed under the {}", "Licensed under {}", "This work is licensed under the {}", "This work is licensed under {}",
           "This file is licensed under the {}", "This software is licensed under the {}", "Licensed under the terms of the {}")

# Short licence texts.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest
in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of
our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and
future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org/>""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is
furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the
following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a
source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT
HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}
# Digests of the canonical form of the long licences' public texts, as systems ship them.
DIGESTS = {
    "Apache-2.0": "5a9385f21630674d59fd055d6ececb22b4bdadbfbd4f8bb53d099f65467869ce",
    "CC0-1.0": "b26895beb460d2caf2b084b6e087328eba00ebee7f9ea5dac4ff4849a91a45c6",
    "GPL-2.0": "fbf4c4ba7c912f668ff89e1b725a09a7909a3040f0d9c52a7d4f9a081b3d6dcd",
    "GPL-3.0": "7bfd6dfdfc194e297480468a4e629d8535b006ea9e28008ee26c19f4296d1f33",
    "LGPL-3.0": "b85864a779a21b84aa02132e48baa62ce41465ea10051d780dedbbc2fbb27a11",
    "MPL-2.0": "9fb6f4bfd7b78f93c45aced3346ba024c6d6b5e1ecb63bea249f03c8c87eff92",
}
# Headings that stand above a text besides the licence's title.
HEADINGS = {"BSL-1.0": "Boost Software License - Version 1.0 - August 17th, 2003", "MIT": "The MIT License (MIT)",
            "BSD-3-Clause": "Revised BSD License", "BSD-2-Clause": "Simplified BSD License"}
# Wordings of one text that are in use beside the listed one: bullets for numbers, the owner for the holder.
WORDINGS = ((r"(?m)^\d\. ", "* "), ("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR"))

# A line that says who holds the copyright: a year, a holder or a sign follows the word. It is matched in the raw text.
COPYRIGHT_LINE = (r"(?i)(^|\n)[^\p{L}\p{N}\n]*(copyright[ \t]*(\(c\)|©|[0-9]{4}|by )|\(c\)[ \t]*[0-9]{4}|©|all rights reserved)[^\n]*")
# Lines that can be a notice hold one of these; every canonical notice does.
NOTICE_HINT = r"(?i)licen[cs]e|released|distributed"


def canonical(text: Column) -> Column:
    """Small letters and digits with single spaces; copyright lines gone, spellings joined."""
    kept = F.regexp_replace(text, COPYRIGHT_LINE, "$1")
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(kept), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for said, meant in SPELLINGS:
        plain = F.replace(plain, F.lit(said), F.lit(meant))
    return F.trim(plain)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_texts() -> list[tuple[str, str]]:
    """(identifier, text) of all notices and short licence texts; with and without a title, in each wording."""
    rows = [(name, form.format(title)) for name, title in NAMES.items() for form in NOTICES]
    for name, body in TEXTS.items():
        bodies = [body]
        for said, other in WORDINGS:
            bodies += [changed for b in bodies if (changed := re.sub(said, other, b)) != b]
        heads = ["", *(f"{title}\n\n" for title in (NAMES[name], HEADINGS.get(name)) if title)]
        rows += [(name, head + b) for head in heads for b in bodies]
    return rows


def known_digests(spark: SparkSession, rows: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license), one row per digest; of two licences with one canonical text the smaller name stays.

    Without ``rows``, the listed texts and notices, and the digests of the long licences.
    """
    texts = spark.createDataFrame(rows or known_texts(), "license string, text string").select(digest(F.col("text")).alias("digest"), "license")
    if rows is None:
        texts = texts.unionByName(spark.createDataFrame([(d, name) for name, d in DIGESTS.items()], "digest string, license string"))
    return texts.groupBy("digest").agg(F.min("license").alias("license"))


def scan(df: DataFrame, known: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of every row, the ``digest`` of its whole canonical text, the ``license`` that the whole text is
    (else null), and the licences its lines give notice of: ``n_notices`` and ``notices`` (sorted, joined by commas).

    A null text counts as empty: no licence. Repeated rows stay apart: they are numbered as in their files, so give
    it a table that is read, or one cut by ``cut_lineage``, not the result of a shuffle. The known
    table is left to the planner, which broadcasts it while it is small.
    """
    carried = without(keep if keep is not None else [c for c in df.columns if c != text_col], ("digest", "license", "n_notices", "notices"))
    renamed = [f"_in{i}" for i in range(len(carried))]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOTICE_HINT))
    units = F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), digest(text).alias("key"))),
        F.transform(lines, lambda x: F.struct(F.lit(False).alias("whole"), digest(x).alias("key"))))
    source = df.select(*[F.col(f"`{c}`").alias(r) for c, r in zip(carried, renamed)], units.alias("_units"),
                       F.monotonically_increasing_id().alias("_row"))
    looked = source.select("_row", *renamed, F.explode("_units").alias("_unit")).select("_row", *renamed, "_unit.*").join(
        known.select(F.col("digest").alias("key"), F.col("license").alias("_license")), "key", "left")
    notice = ~F.col("whole") & F.col("_license").isNotNull()
    grouped = looked.groupBy("_row").agg(
        *[F.first(r).alias(r) for r in renamed], F.max(F.when(F.col("whole"), F.col("key"))).alias("digest"),
        F.max(F.when(F.col("whole"), F.col("_license"))).alias("license"), F.count_if(notice).alias("n_notices"),
        F.array_join(F.sort_array(F.collect_set(F.when(notice, F.col("_license")))), ",").alias("notices"))
    return grouped.select(*[F.col(r).alias(c) for r, c in zip(renamed, carried)], "digest", "license", "n_notices", "notices")
