"""Texts that are a known licence, by digest of their canonical form.

The canonical form is lower case, without copyright notices (lines that begin as one; not lines of a licence's body that a wrap begins with the word), with anything but letters and numbers as one blank, and with one spelling
where licences differ. The digests of known licences are made by the same expressions from the texts below; whole texts
join them by hash. Known licences are a parameter of fixed size and are broadcast; texts stay where they are read.

Defined results: a null or empty text, or one that is nothing but copyright lines, has no words and no licence; rows are kept as
they are, repeats included; if two known licences have one form, the first name in order is given; an empty table gives an empty
table; extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{0}.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
{0}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.
"""

_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this
software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute
it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License."""

#: Published licence texts by their usual short names, with and without their titles.
LICENCES = (
    ("0BSD", _ISC_GRANT.format("")),
    ("0BSD", "Zero-Clause BSD\n" + _ISC_GRANT.format("")),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", _BSD_TERMS.format("")),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_TERMS.format("")),
    ("BSD-3-Clause", _BSD_TERMS.format(_BSD_THIRD)),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_TERMS.format(_BSD_THIRD)),
    ("ISC", _ISC_GRANT.format(", provided that the above copyright notice and this permission notice appear in all copies")),
    ("ISC", "ISC License\n" + _ISC_GRANT.format(", provided that the above copyright notice and this permission notice appear in all copies")),
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("Unlicense", _UNLICENSE),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n" + _ZLIB),
)

#: Words that licences spell in two ways, and the spelling that stands for both.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"), ("favour", "favor"),
    ("fulfil", "fulfill"), ("https", "http"), ("initialise", "initialize"), ("judgement", "judgment"), ("labour", "labor"),
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("maximise", "maximize"), ("merchantibility", "merchantability"),
    ("modelled", "modeled"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("utilisation", "utilization"), ("whilst", "while"),
    ("wilful", "willful"),
)
#: Words that licences write as one, with a hyphen or as two.
TOGETHER = (("sub license", "sublicense"), ("non infringement", "noninfringement"), ("non commercial", "noncommercial"), ("copy right", "copyright"))

#: Of the SQL below, which tells the same only where no line of a licence's body begins with these words.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
#: Words after "copyright" in the body of a licence, at any wrap.
BODY = "notices?|holders?|owners?|laws?|interests?|licen[cs]e[sd]?|statements?|and|or|in|to|of|is|are|on|for|as|by|that|which|with|claims?|rights?|protection|act"
NOTICE = (
    r"(?m)^[^\p{L}\p{N}\n]*(copyright[^\p{L}\p{N}\n]*(\(c\)|©|[0-9])|copyright[^\p{L}\p{N}\n]+(?!(" + BODY + r")\b)\p{L}"
    r"|\(c\)[^\p{L}\p{N}\n]*(copyright|[12][0-9]{3})|©|all rights reserved)[^\n]*$"
)
OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Words of the canonical form, with a blank between them."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOTICE, " ")
    plain = F.regexp_replace(plain, OTHER, " ")
    for apart, one in TOGETHER:
        plain = F.replace(plain, F.lit(apart), F.lit(one))
    spelled = F.create_map(*(F.lit(x) for pair in SPELLINGS for x in pair))
    return F.array_join(F.transform(F.split(F.trim(plain), " "), lambda w: F.coalesce(F.element_at(spelled, w), w)), " ")


def digests(spark: SparkSession, licences: tuple[tuple[str, str], ...] = LICENCES) -> DataFrame:
    """digest and licence of each known form."""
    known = spark.createDataFrame(list(licences), "licence string, text string")
    return known.groupBy(F.sha2(canonical(F.col("text")), 256).alias("known_digest")).agg(F.min("licence").alias("licence"))


def scanned(docs: DataFrame, licences: tuple[tuple[str, str], ...] = LICENCES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, digest (of the canonical form) and licence (or null) of every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.sha2(canonical(F.col(text)), 256).alias("digest"))
    known = F.broadcast(digests(docs.sparkSession, licences))
    joined = rows.join(known, F.col("digest") == F.col("known_digest"), "left")
    empty = F.col("digest") == F.sha2(F.lit(""), 256)
    return joined.select("doc_id", "digest", F.when(~empty, F.col("licence")).alias("licence"))


def _sql_canonical(text: str) -> str:
    out = f"regexp_replace(regexp_replace(lower(coalesce({text}, '')), '{COPYRIGHT_LINE}', ' ', 'g'), '{OTHER}', ' ', 'g')"
    for apart, one in TOGETHER:
        out = f"replace({out}, '{apart}', '{one}')"
    spelled = ", ".join(f"'{a}': '{b}'" for a, b in SPELLINGS)
    return f"array_to_string(list_transform(string_split(trim({out}), ' '), lambda w: coalesce((MAP {{{spelled}}})[w], w)), ' ')"


def _sql_known() -> str:
    return ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in LICENCES)


ORACLE = f"""
WITH known AS (
    SELECT sha256({_sql_canonical("text")}) AS digest, min(licence) AS licence
    FROM (VALUES {_sql_known()}) AS t(licence, text) GROUP BY 1
)
SELECT doc_id, digest, CASE WHEN digest <> sha256('') THEN licence END AS licence
FROM (SELECT doc_id, sha256({_sql_canonical("text")}) AS digest FROM documents) LEFT JOIN known USING (digest)
"""
