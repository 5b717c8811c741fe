"""Licence notices to compare with: names in the usual sentences, SPDX lines, standard headers, and texts.

A template names its licence, gives a text, the words a unit must hold to be meant by it (of these at least one is
rare outside licences), and words it must not hold: these tell versions and kinds of one family apart, which
a cosine alone hardly does.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Template:
    name: str
    text: str
    must: frozenset[str]
    never: frozenset[str] = frozenset()


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


#: what stands before a licence's name
SENTENCES = (
    "Licensed under the {}.",
    "Licensed under {}.",
    "Released under the {}.",
    "This work is licensed under the {}.",
    "This project is licensed under the terms of the {}.",
    "Made available under the terms of the {}.",
    "{}",
)

# fixed values: (SPDX id, names, words a unit must hold, words it must not hold); versions of a name are told by their digits
NAMES: tuple[tuple[str, tuple[str, ...], str, str], ...] = (
    ("MIT", ("MIT License", "MIT"), "mit", ""),
    ("ISC", ("ISC License",), "isc", ""),
    ("Zlib", ("zlib License",), "zlib", ""),
    ("BSL-1.0", ("Boost Software License, Version 1.0",), "boost software 1", ""),
    ("Artistic-2.0", ("Artistic License 2.0",), "artistic 2", ""),
    ("Unlicense", ("Unlicense",), "unlicense", ""),
    ("0BSD", ("Zero-Clause BSD License", "BSD Zero Clause License"), "zero clause bsd", ""),
    ("BSD-2-Clause", ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"), "bsd", "3 4 new zero modified"),
    ("BSD-3-Clause", ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License"), "bsd", "2 4 simplified zero"),
    ("MPL-1.1", ("Mozilla Public License, Version 1.1", "Mozilla Public License, v. 1.1"), "mozilla public 1", "2"),
    ("MPL-2.0", ("Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0"), "mozilla public 2", "1"),
    ("EPL-1.0", ("Eclipse Public License, Version 1.0", "Eclipse Public License v1.0", "Eclipse Public License - v 1.0"), "eclipse public", "2 v2"),
    ("EPL-2.0", ("Eclipse Public License, Version 2.0", "Eclipse Public License v2.0", "Eclipse Public License - v 2.0"), "eclipse public", "1 v1"),
    ("Apache-1.1", ("Apache License, Version 1.1",), "apache 1", "2"),
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"), "apache 2", "1"),
    ("CC0-1.0", ("CC0 1.0 Universal", "CC0 1.0"), "cc0", ""),
)

# fixed values: the GNU licences: id, word in the name, version, what a header calls the work, date of the text
GNU = (
    ("GPL-2.0", "", "2", "program", "June 1991"),
    ("GPL-3.0", "", "3", "program", "29 June 2007"),
    ("LGPL-2.0", "Library ", "2", "library", "June 1991"),
    ("LGPL-2.1", "Lesser ", "2.1", "library", "February 1999"),
    ("LGPL-3.0", "Lesser ", "3", "program", "29 June 2007"),
    ("AGPL-3.0", "Affero ", "3", "program", "19 November 2007"),
)

# fixed values: Creative Commons licences: code, words of the name
COMMONS = (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
COMMONS_VERSIONS = (("4.0", "International"), ("3.0", "Unported"), ("2.0", "Generic"))

# fixed values: public notices and texts, as files and headers carry them
TEXTS: tuple[tuple[str, str, str, str], ...] = (
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
        " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        ' software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
        " See the License for the specific language governing permissions and limitations under the License.",
        "apache 2",
        "",
    ),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", "apache 2 2004", ""),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),'
        " to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
        " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "permission granted sublicense",
        "",
    ),
    (
        "MIT",
        'MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),'
        " to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
        " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
        ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,'
        " FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,"
        " WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "permission granted sublicense",
        "",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
        " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
        " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"
        " and/or other materials provided with the distribution.",
        "redistributions binary reproduce",
        "endorse neither advertising",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
        " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
        " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation"
        " and/or other materials provided with the distribution."
        " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"
        " without specific prior written permission.",
        "redistributions endorse neither",
        "advertising",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies.",
        "permission fee granted provided",
        "",
    ),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "permission fee granted", "provided"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
        " If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "mozilla 2",
        "1",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2", "1"),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"
        " which is available at https://www.eclipse.org/legal/epl-2.0/",
        "eclipse 2",
        "1",
    ),
    (
        "EPL-1.0",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"
        " which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
        "eclipse v1",
        "2",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from"
        " the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and"
        " redistribute it freely, subject to the following restrictions:",
        "permission granted alter freely",
        "",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)", "boost software", ""),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work.", "waived copyright", ""),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,"
        " either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "unencumbered domain",
        "",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered domain", ""),
)


def _spdx(name: str) -> list[Template]:
    """Identifier lines. What an id holds, a line for another id of the family must not lack: its words, all of them."""
    parts = "".join(c if c.isalnum() else " " for c in name.lower()).split()
    family = {"nc", "nd", "sa", "clause"} - set(parts)
    more = {"1", "2", "3", "4"} - set(parts) if {"1", "2", "3", "4"} & set(parts) else set()
    tails = ("", "-only", "-or-later") if "GPL" in name else ("",)
    return [Template(name, f"SPDX-License-Identifier: {name}{tail}", frozenset({"spdx", "identifier", *parts}), frozenset(family | more)) for tail in tails]


def _gnu() -> list[Template]:
    out = []
    for name, kind, version, work, date in GNU:
        own = kind.strip().lower()
        digits = version.split(".")
        # a header may call the work a library whatever its licence
        never = frozenset({k for k in ("lesser", "affero") if k != own} | ({"3"} if version != "3" else {"2"}))
        must = frozenset({"public", "general", *digits, *([own] if own else [])})
        full = f"GNU {kind}General Public License"
        grant = (
            f"This {work} is free software: you can redistribute it and/or modify it under the terms of the {full} as published by"
            f" the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
        )
        rest = (
            f" This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
            f" MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {full} for more details."
            f" You should have received a copy of the {full} along with this {work}. If not, see <https://www.gnu.org/licenses/>."
        )
        only = grant.replace(f"either version {version} of the License, or (at your option) any later version.", f"version {version} of the License.")
        texts = [grant, grant + rest, only, f"{full} Version {version}, {date}"]
        texts += [s.format(f"{full}, version {version}") for s in SENTENCES]
        out += [Template(name, t, must, never) for t in texts]
        short = name.split("-")[0]
        for spelled, held in ((f"{short} {version}", {short.lower(), *digits}), (f"{short} v{version}", {short.lower(), f"v{digits[0]}", *digits[1:]}), (f"{short}v{version}", {f"{short.lower()}v{digits[0]}", *digits[1:]})):
            out += [Template(name, s.format(spelled), frozenset(held)) for s in SENTENCES[:3]]
        v = [Template(name, s.format(f"{full} v{version}"), (must - set(digits)) | {f"v{digits[0]}", *digits[1:]}, frozenset(k for k in never if not k.isdigit())) for s in SENTENCES[:3]]
        out += [*v, *_spdx(name)]
    return out


def _commons() -> list[Template]:
    out = []
    codes = {"sa", "nd", "nc"}
    words = {"sharealike", "noderivatives", "noderivs", "noncommercial"}
    for code, long in COMMONS:
        for version, place in COMMONS_VERSIONS:
            name = f"CC-{code}-{version}"
            parts = set(code.lower().split("-"))
            digit = version[0]
            other = {d for d in "234" if d != digit}
            out += [Template(name, s.format(f"CC {code} {version}"), frozenset({"cc", "by", digit, *parts}), frozenset(codes - parts | other)) for s in SENTENCES]
            held = {w.lower() for w in long.split("-")}
            full = f"Creative Commons {long} {version}"
            must = frozenset({"creative", "commons", digit, *held})
            out += [Template(name, s.format(t), must, frozenset(words - held | other)) for t in (f"{full} {place} License", full) for s in SENTENCES[:4]]
            out += _spdx(name)
    return out


def _named() -> list[Template]:
    out = []
    for name, spellings, must, never in NAMES:
        for spelling in spellings:
            held = _words(must) | frozenset(w for w in "2 3 v1 v2".split() if name.startswith(("BSD", "EPL")) and w in _tokens(spelling))
            out += [Template(name, s.format(spelling), held, _words(never)) for s in (SENTENCES if spelling != "MIT" else SENTENCES[:-1])]
        out += _spdx(name)
    return out


def _tokens(text: str) -> set[str]:
    return set("".join(c if c.isalnum() else " " for c in text.lower()).split())


TEMPLATES: tuple[Template, ...] = tuple(
    dict.fromkeys([*_named(), *_gnu(), *_commons(), *(Template(name, text, _words(must), _words(never)) for name, text, must, never in TEXTS)])
)
