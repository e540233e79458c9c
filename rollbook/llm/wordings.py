"""Bodies, headers and SPDX lines of common licenses; the longer bodies lie in ``licenses/``."""

from __future__ import annotations

from pathlib import Path

_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_MIT_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software. "
)


def _gnu(name: str, version: str, what: str = "This program") -> str:
    return (
        f"{what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published "
        f"by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
    )


#: More forms of each license, after those of ``license.NOTICES``.
WORDINGS = {
    "MIT": {"body": _MIT + _MIT_AS_IS, "grant": _MIT, "as-is": _MIT_AS_IS},
    "ISC": {
        "body": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    },
    "BSD-2-Clause": {"body": _BSD_2 + _AS_IS},
    "BSD-3-Clause": {
        "body": _BSD_2 + "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission. " + _AS_IS,
        "as-is": _AS_IS,
    },
    "Unlicense": {
        "body": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for "
        "any purpose, commercial or non-commercial, and by any means.",
    },
    "GPL-2.0": {"header": _gnu("General Public License", "2")},
    "LGPL-2.1": {"header": _gnu("Lesser General Public License", "2.1", "This library")},
    "LGPL-3.0": {"header": _gnu("Lesser General Public License", "3")},
    "AGPL-3.0": {"header": _gnu("Affero General Public License", "3")},
    "CC0-1.0": {"header": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."},
    "CC-BY-SA-4.0": {
        "header": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "short": "Licensed under CC BY-SA 4.0.",
    },
}
_SPDX = (
    "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause",
    "BSD-3-Clause", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "MPL-2.0", "MIT", "ISC", "Unlicense",
)


def rows() -> list[tuple[str, str]]:
    """Template ids and texts."""
    out = [(f"{name}/{form}", text) for name, forms in WORDINGS.items() for form, text in forms.items()]
    out += [(f"{p.name.removesuffix('.txt')}/text", p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]
    return out + [(f"{name}/spdx", f"SPDX-License-Identifier: {name}") for name in _SPDX]
