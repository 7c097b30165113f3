"""Known licence texts and notices."""

from __future__ import annotations

import re
from importlib.resources import files
from itertools import permutations, product

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""

_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""

_ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

#: The texts and notices as their authors publish them.
KNOWN = [
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", _MIT_GRANT),
    ("BSD-2-Clause", f"{_BSD_HEAD}\n\n{_BSD_TAIL}"),
    ("BSD-3-Clause", f"{_BSD_HEAD}\n\n{_BSD_THIRD}\n\n{_BSD_TAIL}"),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice "
            f"appear in all copies.\n\n{_ISC_TAIL}"),
    ("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_TAIL}"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
]

#: Spellings that count as equal when licence texts are matched.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"),
    ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"),
    ("favour", "favor"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("licenced", "licensed"),
    ("licences", "licenses"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("owner", "holder"), ("owners", "holders"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("sublicence", "sublicense"), ("utilisation", "utilization"),
    ("whilst", "while"), ("wilful", "willful"),
]

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

#: Titles under which short licences are published.
_TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License"],
    "ISC": ["ISC License", "The ISC License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "Zlib": ["zlib License", "The zlib License"],
}

_GNU = [
    ("GPL", "General", ["1.0", "2.0", "3.0"]), ("LGPL", "Lesser General", ["2.1", "3.0"]),
    ("LGPL", "Library General", ["2.0"]), ("AGPL", "Affero General", ["3.0"]),
]

#: How sentences name a licence, without an article.
_NAMES = {
    "MIT": ["MIT License", "MIT"],
    "Apache-2.0": [
        "Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License",
        "Apache-2.0 License", "Apache 2.0", "Apache License, Version 2.0 (the \"License\")",
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD-3-Clause",
    ],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD License", "0BSD License", "0BSD"],
    "ISC": ["ISC License", "ISC"],
    "Zlib": ["zlib License", "zlib"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0", "BSL-1.0"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": [
        "CC0 1.0", "CC0 1.0 Universal", "CC0", "Creative Commons Zero v1.0 Universal",
        "Creative Commons CC0 1.0 Universal License",
    ],
    "MPL-1.1": ["Mozilla Public License, Version 1.1", "Mozilla Public License 1.1", "MPL 1.1"],
    "MPL-2.0": [
        "Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0",
        "Mozilla Public License v2.0", "MPL 2.0", "MPLv2",
    ],
    "EPL-1.0": ["Eclipse Public License, Version 1.0", "Eclipse Public License 1.0", "Eclipse Public License v1.0", "EPL 1.0"],
    "EPL-2.0": ["Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0", "EPL 2.0"],
    "EUPL-1.2": ["European Union Public License 1.2", "EUPL, Version 1.2", "EUPL 1.2"],
    "CDDL-1.0": ["Common Development and Distribution License 1.0", "CDDL 1.0"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1", "OFL 1.1"],
    "Artistic-2.0": ["Artistic License 2.0", "Artistic License, Version 2.0"],
    "WTFPL": ["WTFPL", "Do What The Fuck You Want To Public License"],
}


#: What sentences may call the work.
SUBJECTS = ["work", "project", "software", "program", "library", "file", "code"]

#: Identifiers that identifier lines join by twos.
USUAL = [
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "0BSD", "Zlib", "BSL-1.0", "Unlicense", "CC0-1.0",
    "MPL-2.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "CC-BY-4.0",
]


def names() -> list[tuple[str, str]]:
    """Licences and how sentences name them. Of the GNU licences a bare "GPL-3.0" or "GPLv3" is named
    as such, since the plus sign of "GPLv3+" does not survive the normalisation."""
    named = [(key, name) for key, names in _NAMES.items() for name in names]
    for short, long, versions in _GNU:
        for full in versions:
            v = full.removesuffix(".0")
            for title, sep in product((f"GNU {long} Public License", f"GNU {short}"), (", version ", " version ", " v")):
                for number in {v, full}:
                    name = f"{title}{sep}{number}"
                    named += [(f"{short}-{full}-only", x) for x in (name, f"{name} only")]
                    named += [(f"{short}-{full}-or-later", f"{name} {x}") for x in (
                        "or later", "or any later version", "or (at your option) any later version")]
            for name in {f"{short}v{v}", f"{short} v{v}", f"{short}-{full}", f"{short} {v}"}:
                named += [(f"{short}-{full}", name), (f"{short}-{full}", f"{name} License"),
                          (f"{short}-{full}-only", f"{name} only"), (f"{short}-{full}-or-later", f"{name} or later")]
    for version in ("1.2", "1.3"):
        named += [(f"GFDL-{version}-only", f"GNU Free Documentation License{x}{version}") for x in (", version ", " ")]
    words = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            key = f"CC-{kind}-{version}"
            long = "-".join(words[x] for x in kind.split("-"))
            scopes = ["", " International"] if version == "4.0" else ["", " Unported"]
            for title, scope in product((f"CC {kind}", f"Creative Commons {long}"), scopes):
                named += [(key, f"{title} {version}{scope}"), (key, f"{title} {version}{scope} License")]
    return named


def sentences() -> list[tuple[str, str]]:
    """Sentences that put a work under a licence."""
    subjects = ["", *(f"This {x} is " for x in SUBJECTS)]
    verbs = ["licensed", "released", "distributed"]
    starts = [f"{s}{v} under {a}" for s, v, a in product(subjects, verbs, ("", "the ", "the terms of the "))]
    made = [(key, f"{start}{name}.") for (key, name), start in product(names(), starts)]
    return made + [
        (key, f"{start}a {name}.") for key, name in names() if key.startswith("CC-")
        for start in (f"{s}{v} under " for s, v in product(subjects, verbs))
    ]


def listed(name: str) -> list[str]:
    return files("tidegauge.llm").joinpath(name).read_text("utf-8").split()


def spdx_lines() -> list[tuple[str, str]]:
    """Identifier lines: every identifier of the SPDX list (3.27), the GNU and Apache ones with every
    exception, and two of the usual ones joined by OR or AND."""
    ids = listed("spdx_ids.txt")
    made = list(ids)
    made += [
        f"{x} WITH {e}" for x in ids if x.startswith(("GPL-", "LGPL-", "AGPL-", "Apache-2.0"))
        for e in listed("spdx_exceptions.txt")
    ]
    rows = [(x, f"SPDX-License-Identifier: {x}") for x in made]
    return rows + [
        (f" {word} ".join(sorted(two)), f"SPDX-License-Identifier: {f' {word} '.join(two)}")
        for two in permutations(USUAL, 2) for word in ("OR", "AND")
    ]


def headers() -> list[tuple[str, str]]:
    """The notices that licences of several pages ask for."""
    made = [("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
             "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")]
    for short, long, versions in _GNU:
        for full, mark, thing in product(versions, (":", ";"), ("program", "software", "library", "file")):
            title, v = f"GNU {long} Public License", full.removesuffix(".0")
            start = (f"This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of "
                     f"the {title} as published by the Free Software Foundation")
            rest = (
                f"This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
                f"even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {title} "
                f"for more details.\n\nYou should have received a copy of the {title} along with this {thing}. "
                "If not, see <https://www.gnu.org/licenses/>."
            )
            for key, grant in (
                ("or-later", f"{start}, either version {v} of the License, or (at your option) any later version."),
                ("only", f"{start}, version {v}."), ("only", f"{start}, version {v} of the License."),
            ):
                made += [(f"{short}-{full}-{key}", x) for x in (grant, f"{grant}\n\n{rest}")]
    return made


def whole_texts() -> list[tuple[str, str]]:
    """Whole licences: the short ones under their titles, the long ones with and without what follows
    their terms. The text of a GNU licence does not say whether later versions are allowed."""
    short = [(key, text) for key, text in KNOWN[:6] if not text.startswith("MIT License")] + [("Zlib", _ZLIB)]
    short += [
        (key, re.sub(r"(?m)^\d\. ", "* ", text)) for key, text in short if key.startswith("BSD-")
    ]
    made = short + [(key, f"{title}\n\n{text}") for key, text in short for title in _TITLES[key]]
    for file in sorted(files("tidegauge.llm").joinpath("licenses").iterdir(), key=lambda f: f.name):
        text = file.read_text("utf-8")
        key = file.name.removesuffix(".txt")
        end = text.find("END OF TERMS AND CONDITIONS")
        parts = [text] if end < 0 else [text, text[:end], text[:end] + "END OF TERMS AND CONDITIONS"]
        made += [(key, part) for part in parts]
    return made


def known_texts() -> list[tuple[str, str]]:
    """Licence and text of all that is known; links in either protocol."""
    long = whole_texts() + headers()
    linked = [(key, text.replace("http://", "https://")) for key, text in long]
    linked += [(key, text.replace("https://", "http://")) for key, text in linked]
    alike = {
        (key, re.sub(r"[\W_]+", " ", text.lower()).strip()): text for key, text in [*sentences(), *spdx_lines()]
    }
    return sorted({*KNOWN, *long, *linked, *((key, text) for (key, _), text in alike.items())})
