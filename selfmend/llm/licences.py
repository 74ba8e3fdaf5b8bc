"""License scans by canonical digest.

A text is brought to a canonical form (lower case, copyright lines left out,
equivalent spellings made one, everything but letters and digits a blank) and
its SHA-256 is looked up in the digests of known licences: entire texts by a
hash join with the catalogue, each line (a notice such as "Licensed under the
Apache License, Version 2.0.") by a map of notice digests. The catalogue is a
constant of this module -- short licences as texts, long ones (GNU, Apache,
Mozilla, Artistic, CC0) as the digests of their canonical form, whole and
without their appendix -- so its size does not depend on the data. A table of
further licence texts can be given. The same expression makes the canonical
form of the catalogue and of the documents.

Defined cases: a NULL text has no digest, licence or notice; a text without
letters or digits has a digest but no licence; repeated rows get a row each;
two catalogue entries with one digest are refused. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: texts of common licences
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
_BSD_GRANT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

#: Licence, whether its title may stand above it, text.
TEXTS = (
    ("MIT", "MIT License", _MIT_GRANT),
    ("ISC", "ISC License", f"{_ISC_GRANT}\n\n{_ISC_DISCLAIMER}"),
    ("0BSD", "BSD Zero Clause License",
     f"{_ISC_GRANT.split(', provided')[0]}.\n\n{_ISC_DISCLAIMER}"),
    ("BSD-2-Clause", "BSD 2-Clause License", f"{_BSD_GRANT}\n\n{_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", "BSD 3-Clause License", f"{_BSD_GRANT}\n\n{_BSD_THIRD}\n\n{_BSD_DISCLAIMER}"),
    ("Zlib", "zlib License", _ZLIB),
    ("Apache-2.0-header", "", _APACHE_HEADER),
)
#: Licence and a line that announces it.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This work is licensed under the Mozilla Public License, version 2.0."),
    ("CC0-1.0", "This work is licensed under CC0 1.0 Universal."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    *((f"CC-{kind.replace(' ', '-')}-{v}", f"{lead} CC {kind} {v}.") for lead in ("Licensed under", "This work is licensed under")
      for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0")),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)
#: Words that may follow "copyright" in a sentence: it is no holder's line then.
_IN_SENTENCES = ("notice", "holder", "owner", "law", "licen", "protect", "disclaimer", "interest", "and ", "or ", "in ", "of ", "on ", "is ",
                 "to ", "treat", "statement", "permission", "right", "grant", "for ", "under ", "as ", "act", "claim", "term", "work")
_PROTECTED = tuple((f"copyright {w}", f"copyright_{w}") for w in _IN_SENTENCES)
#: fixed values: licence and canonical digest of long texts
DIGESTS = (
    ("Apache-2.0", "75acde0fb516a7ba4597dfc23680cf78281f7fae7f3b74a78e06ef83c1c375c6"),
    ("Apache-2.0", "f9138026e58bdb767e6c6e974637ff9aacbaedf2695e30fef144e5d7d84448ff"),
    ("Apache-2.0", "6fb8411669deea22294b6190fad00b8e39899d0b7b6c5cf97a3b15b47e129c38"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b"),
    ("GFDL-1.2", "1dbd72b6f124a1058e786b52a9d4afe44543b834a3aa44faf6c18b747c9de8e2"),
    ("GFDL-1.3", "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("GFDL-1.3", "911b9e1b02471fa9b19ec482d019380acd7e0fef00ffbd4395e8813b06533fe7"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
)
#: Spellings made one, in lower case; each is replaced wherever it occurs.
SPELLINGS = (
    ("licence", "license"), ("sub-license", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"), ("non-infringement", "noninfringement"), ("organis", "organiz"),
    ("recognis", "recogniz"), ("authoris", "authoriz"), ("favour", "favor"), ("judgement", "judgment"),
    ("fulfilment", "fulfillment"), ("whilst", "while"), ("copyright owner", "copyright holder"),
    ("per cent", "percent"), ("https://", "http://"), ("&", " and "),
)
#: A line that names a copyright holder, or reserves all rights.
COPYRIGHT_LINE = (r"^[ \t*#/;-]*(?:(?:copyright[ \t]*(?:\(c\)|©|[0-9<\[{])|\(c\)[ \t]*[0-9<\[{]|©)[^\n]*"
                  r"|copyright[ \t]+[^ \t\n][^\n]{1,80}|all rights reserved[.]?[ \t]*)$")
_OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    text = reduce(lambda t, s: F.replace(t, F.lit(s[0]), F.lit(s[1])), _PROTECTED, F.lower(text))
    text = F.regexp_replace(text, "(?md)" + COPYRIGHT_LINE, "")
    text = reduce(lambda t, s: F.replace(t, F.lit(s[0]), F.lit(s[1])), SPELLINGS, text)
    return F.trim(F.regexp_replace(text, _OTHER, " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def canonical_text(text: str) -> str:
    """The canonical form in plain Python, for the catalogue."""
    text = reduce(lambda t, s: t.replace(*s), _PROTECTED, text.lower())
    text = re.sub(COPYRIGHT_LINE, "", text, flags=re.M)
    for a, b in SPELLINGS:
        text = text.replace(a, b)
    return re.sub(r"[\W_]+", " ", text).strip(" ")


def _digests(entries) -> dict[str, str]:
    out: dict[str, str] = {}
    for licence, text in entries:
        key = hashlib.sha256(canonical_text(text).encode()).hexdigest()
        if out.setdefault(key, licence) != licence:
            raise ValueError(f"{licence} and {out[key]} have one canonical form")
    return out


def text_digests() -> dict[str, str]:
    """Digest to licence, for the catalogue's texts with and without title, and the long ones."""
    short = _digests([(n, t) for n, _, t in TEXTS] + [(n, f"{title}\n\n{t}") for n, title, t in TEXTS if title])
    return short | {k: n for n, k in DIGESTS}


def notice_digests() -> dict[str, str]:
    return _digests(NOTICES)


def scan(docs: DataFrame, further: DataFrame | None = None) -> DataFrame:
    """Per row: ``doc_id``, the canonical ``digest``, the ``licence`` whose
    entire text it is (NULL if none) and the licences of its ``notices``.
    ``further`` licences (``licence, text``) are looked up too; of several with
    one digest the least name counts, the catalogue's own before them."""
    known = docs.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("known"), F.lit(v).alias("licence")) for k, v in text_digests().items()])).alias("c")) \
        .select("c.known", "c.licence")
    notices = F.create_map(*[F.lit(x) for kv in notice_digests().items() for x in kv])
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.get(F.array(notices), F.lit(0))[digest(x)]),
                     lambda x: x.isNotNull())
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"),
                       F.coalesce(F.array_join(F.sort_array(F.array_distinct(lines)), ","), F.lit("")).alias("notices"))
    # the catalogue is a constant, so broadcasting it is bounded
    rows = rows.join(F.broadcast(known), F.col("digest") == F.col("known"), "left")
    if further is not None:     # Spark broadcasts a small table and splits a hot digest otherwise
        more = further.where("licence IS NOT NULL AND text IS NOT NULL").groupBy(digest(F.col("text")).alias("also")) \
            .agg(F.min("licence").alias("further"))
        rows = rows.join(more, F.col("digest") == F.col("also"), "left").withColumn("licence", F.coalesce("licence", "further"))
    return rows.select("doc_id", "digest", "licence", "notices")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql(text: str) -> str:
    out = f"lower({text})"
    for a, b in _PROTECTED:
        out = f"replace({out}, {_quoted(a)}, {_quoted(b)})"
    out = f"regexp_replace({out}, {_quoted('(?m)' + COPYRIGHT_LINE)}, '', 'g')"
    for a, b in SPELLINGS:
        out = f"replace({out}, {_quoted(a)}, {_quoted(b)})"
    return f"sha256(trim(regexp_replace({out}, {_quoted(_OTHER)}, ' ', 'g')))"


def _values(entries) -> str:
    return ", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in entries)


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
t AS (SELECT DISTINCT licence, {_sql('t')} AS k FROM (VALUES {_values(
    [(n, t) for n, _, t in TEXTS] + [(n, f'{title} {t}') for n, title, t in TEXTS if title])}) v(licence, t)
      UNION ALL SELECT licence, k FROM (VALUES {_values(DIGESTS)}) v(licence, k)),
n AS (SELECT DISTINCT licence, {_sql('t')} AS k FROM (VALUES {_values(NOTICES)}) v(licence, t)),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
f AS (SELECT r, string_agg(DISTINCT n.licence, ',' ORDER BY n.licence) AS notices FROM l JOIN n ON n.k = {_sql('l.line')} GROUP BY r),
w AS (SELECT r, doc_id, {_sql('text')} AS digest FROM d)
SELECT doc_id, digest, t.licence AS licence, coalesce(f.notices, '') AS notices
FROM w LEFT JOIN t ON t.k = w.digest LEFT JOIN f USING (r)
"""
