"""The licences that scans look up besides those written out in ``licences``: (licence, text) rows.

``licence_texts/`` holds one whole text per file, named by its SPDX identifier and copied once from the texts
that Debian and Python packages ship.  A text is known in the usual wraps, with either spelling of its links,
with and without its appendix, and a short one under its usual titles.  Of notices the SPDX line, the usual
sentences and the first lines of the usual headers are known.
"""

from __future__ import annotations

import itertools
import pkgutil
import re

# -- whole texts --------------------------------------------------------------------------------

LONG = ["Apache-2.0", "Artistic-1.0-Perl", "BSL-1.0", "CC0-1.0", "GFDL-1.2-only", "GFDL-1.3-only", "GPL-1.0-only", "GPL-2.0-only",
        "GPL-3.0-only", "LGPL-2.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-1.1", "MPL-2.0", "Unlicense"]
TITLES = {
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD 0-Clause License"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "Zlib": ["zlib License", "The zlib License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "BSD 2-Clause \"Simplified\" License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "BSD 3-Clause \"New\" or \"Revised\" License"],
}
RESERVED = "All rights reserved."
APPENDIX = r"(?s)(END OF TERMS AND CONDITIONS).*"
DROPPED = re.compile(r"[^a-z0-9]*(copyright|\(c\)|©)")  # as scans drop lines
NOTICE = re.compile(r"[^a-z0-9]*(copyright|©)\s*(\(c\)|©|\[|<|\d)")


def _text(name: str) -> str:
    return pkgutil.get_data(__package__, f"licence_texts/{name}.txt").decode()


def _joined(text: str, joins) -> str:
    """``text`` with each line that ``joins`` put behind the line before it; copyright notices stay lines."""
    out = [""]
    for line in text.split("\n"):
        if joins(out[-1], line) and not NOTICE.match(line.lower()) and not NOTICE.match(out[-1].lower()):
            out[-1] += " " + line.strip()
        else:
            out.append(line)
    return "\n".join(out)


def _wraps(text: str) -> list[str]:
    """As it stands; without a line that is dropped by chance; every paragraph one line."""
    return [text, _joined(text, lambda before, line: DROPPED.match(line.lower())),
            _joined(text, lambda before, line: before.strip() and line.strip())]


def _links(text: str) -> list[str]:
    return [re.sub(r"https?://", scheme, text) for scheme in ("http://", "https://")]


def _bsd(text: str) -> list[str]:
    """Conditions numbered or not, the holder in singular or plural where the text names it."""
    out = []
    for marked in (text, re.sub(r"(?m)^(\s*)\d\. ", r"\1* ", text)):
        for by, liable in itertools.product(("HOLDER", "HOLDERS"), repeat=2):
            out.append(re.sub(r"HOLDERS?(\s+OR\s)", rf"{liable}\1", re.sub(r"HOLDERS?(\s+AND\s)", rf"{by}\1", marked)))
    return out


def _texts(known: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """``known`` are short texts written out elsewhere."""
    out = []
    for name in LONG:
        whole = _text(name)
        out += [(name, w) for part in (whole, re.sub(APPENDIX, r"\1", whole)) for link in _links(part) for w in _wraps(link)]
    bodies = [(name, text) for name, text in known if name in TITLES and len(text) > 500]
    bodies += [("ISC", _text("ISC")), ("MIT", _text("MIT"))]
    for name, file in (("BSD-2-Clause",) * 2, ("BSD-3-Clause",) * 2, ("BSD-3-Clause", "BSD-3-Clause-University")):
        bodies += [(name, t) for t in _bsd(_text(file))]
    for name, body in bodies:
        heads = [f"{title}\n" for title in ["", *TITLES[name]]]
        out += [(name, head + right + w) for w in _wraps(body) for head in heads for right in ("", f"{RESERVED}\n")]
    return out


# -- notices ------------------------------------------------------------------------------------

NAMES = {
    "0BSD": ["BSD Zero Clause License", "0BSD License"],
    "AGPL-3.0-only": ["GNU Affero General Public License v3.0", "GNU AGPLv3", "AGPL-3.0 License", "AGPLv3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License", "Apache 2.0"],
    "Artistic-2.0": ["Artistic License 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal License", "Creative Commons Zero v1.0 Universal License"],
    "EPL-1.0": ["Eclipse Public License v1.0", "Eclipse Public License 1.0"],
    "EPL-2.0": ["Eclipse Public License v2.0", "Eclipse Public License 2.0"],
    "GPL-2.0-only": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPLv2", "GPL-2.0 License", "GPLv2"],
    "GPL-3.0-only": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPLv3", "GPL-3.0 License", "GPLv3"],
    "ISC": ["ISC License"],
    "LGPL-2.1-only": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPLv2.1", "LGPLv2.1"],
    "LGPL-3.0-only": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "GNU LGPLv3", "LGPLv3"],
    "MIT": ["MIT License", "MIT license (MIT)"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License"],
}
CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
            "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
NAMES |= {f"CC-{k}-4.0": [f"CC {k} 4.0", f"Creative Commons {name} 4.0 International License"] for k, name in CREATIVE.items()}
NAMES |= {f"CC-{k}-3.0": [f"CC {k} 3.0", f"Creative Commons {name} 3.0 Unported License"]
          for k, name in CREATIVE.items() if "ND" not in k}
SUBJECTS = ["", "This project is ", "This software is ", "This work is ", "This code is "]
VERBS = ["licensed under", "released under", "distributed under", "licensed under the terms of"]
ENDS = [" - see the LICENSE file for details", " - see the [LICENSE](LICENSE) file for details",
        " - see the [LICENSE.md](LICENSE.md) file for details"]
SPDX = [*NAMES, *(f"{k}-or-later" for k in ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0")), "Apache-2.0 WITH LLVM-exception"]
OF_GNU = ("This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} as published by "
          "the Free Software Foundation{mark2} either version {version} of the License, or (at your option) any later version.")
HEADERS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "The ASF licenses this file to You under the Apache License, Version 2.0"),
    ("MPL-2.0", "License, v. 2.0. If a copy of the MPL was not distributed with this"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at"),
]
GNU = [("GPL-2.0-or-later", "General Public License", "2"), ("GPL-3.0-or-later", "General Public License", "3"),
       ("LGPL-2.1-or-later", "Lesser General Public License", "2.1"), ("LGPL-3.0-or-later", "Lesser General Public License", "3"),
       ("AGPL-3.0-or-later", "Affero General Public License", "3")]


def _notices() -> list[tuple[str, str]]:
    out = [(name, f"SPDX-License-Identifier: {name}") for name in SPDX]
    for name, called in NAMES.items():
        for what in called:
            articles = ("a ", "the ") if what.startswith("Creative") else ("the ", "")
            out += [(name, f"{s}{verb} {article}{what}") for s, verb, article in itertools.product(SUBJECTS, VERBS, articles)]
            out += [(name, f"This project is licensed under the {what}{end}") for end in ENDS]
    out += [(name, OF_GNU.format(what=what, mark=";", mark2=";", kind=kind, version=version))
            for name, kind, version in GNU for what in ("program", "library", "file", "software")]
    return out + HEADERS


def rows(known: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(licence, text) rows besides ``known``, each text once but for white space, signs and case."""
    def key(text: str) -> str:
        lines = [line for line in text.lower().split("\n") if not DROPPED.match(line)]
        return " ".join(re.findall(r"[^\W_]+", " ".join(lines)))

    seen, out = {key(text) for _, text in known}, []
    for name, text in _texts(known) + _notices():
        if (k := key(text)) not in seen:
            seen.add(k)
            out.append((name, text))
    return out
