"""Known licences and notices: fixed values."""

from pathlib import Path

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
)
_MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE.\n"
)
_MIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n\n"
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies"
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
    "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.\n"
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.\n"
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software.\n\n"
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
    "alter it and redistribute it freely, subject to the following restrictions:\n\n"
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. "
    "If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is "
    "not required.\n"
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
    "software.\n"
    "3. This notice may not be removed or altered from any source distribution.\n"
)
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
    "the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on '
    'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
    "specific language governing permissions and limitations under the License.\n"
)

_MPL_NOTICE = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
)


def _gnu_notices():
    """The paragraphs that GNU licences ask to stand at the head of a file."""
    families = (("GPL", "General Public License", ("2", "3")), ("LGPL", "Lesser General Public License", ("2.1", "3")), ("AGPL", "Affero General Public License", ("3",)))
    for key, name, versions in families:
        for version in versions:
            for thing in ("program", "library", "software"):
                for mark in (":", ";"):
                    for later in (", either version {v} of the License, or (at your option) any later version.", ", version {v}.", ", version {v} of the License.", "; version {v}."):
                        grant = f"This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation"
                        yield f"{key}-{version if '.' in version else version + '.0'}", grant + later.format(v=version)


_GNU_NOTICES = list(_gnu_notices())

# fixed values: names that lines use for a licence
NAMES = [
    ("MIT", ("MIT", "the MIT License", "an MIT license")),
    ("MIT-0", ("MIT-0",)),
    ("ISC", ("ISC", "the ISC License")),
    ("0BSD", ("0BSD",)),
    ("BSD-2-Clause", ("BSD-2-Clause", "the BSD 2-Clause License")),
    ("BSD-3-Clause", ("BSD-3-Clause", "the BSD 3-Clause License")),
    ("Zlib", ("the zlib License",)),
    ("Apache-2.0", ("Apache-2.0", "Apache 2.0", "the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License")),
    ("MPL-2.0", ("MPL-2.0", "MPL 2.0", "the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0")),
    ("GPL-2.0", ("GPL-2.0", "GPLv2", "the GNU General Public License, version 2", "the GNU General Public License v2.0")),
    ("GPL-3.0", ("GPL-3.0", "GPLv3", "the GNU General Public License, version 3", "the GNU General Public License v3.0")),
    ("LGPL-2.1", ("LGPL-2.1", "LGPLv2.1", "the GNU Lesser General Public License, version 2.1")),
    ("LGPL-3.0", ("LGPL-3.0", "LGPLv3", "the GNU Lesser General Public License, version 3")),
    ("AGPL-3.0", ("AGPL-3.0", "AGPLv3", "the GNU Affero General Public License, version 3", "the GNU Affero General Public License v3.0")),
    ("Unlicense", ("the Unlicense",)),
    ("CC0-1.0", ("CC0", "CC0 1.0", "CC0 1.0 Universal")),
    *((f"CC-{kind}-{v}", (f"CC-{kind}-{v}", f"CC {kind} {v}", f"a Creative Commons {kind} {v} license")) for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0")),
]
# fixed values: lines that state one
STATEMENTS = (
    "Licensed under {name}.",
    "License: {name}",
    "Released under {name}.",
    "Distributed under {name}.",
    "Available under {name}.",
    "This work is licensed under {name}.",
    "This project is licensed under {name}.",
    "This project is licensed under the terms of {name}.",
    "This software is released under {name}.",
    "This file is licensed under {name}.",
    "The code is licensed under {name}.",
)

# (name, text)
LICENSES = [
    ("MIT", "MIT License\n\n" + _MIT_GRANT + _MIT_NOTICE + _MIT_WARRANTY),
    ("MIT", _MIT_GRANT + _MIT_NOTICE + _MIT_WARRANTY),
    ("MIT-0", "MIT No Attribution\n\n" + _MIT_GRANT.replace(", subject to the following conditions:", ".") + _MIT_WARRANTY),
    ("ISC", "ISC License\n\n" + _ISC_GRANT + _ISC_NOTICE + ".\n\n" + _ISC_WARRANTY),
    ("ISC", _ISC_GRANT + _ISC_NOTICE + ".\n\n" + _ISC_WARRANTY),
    ("0BSD", _ISC_GRANT + ".\n\n" + _ISC_WARRANTY),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_GRANT + _BSD_WARRANTY),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_WARRANTY),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_GRANT + _BSD_NAMES + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAMES + _BSD_WARRANTY),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("Zlib", _ZLIB),
    ("Apache-2.0", _APACHE_NOTICE),
    *((name, text) for name, text in _GNU_NOTICES),
    ("MPL-2.0", _MPL_NOTICE),
    # full texts, as their publishers give them
    *((f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "license_files").glob("*.txt"))),
    # what a line says of a licence
    *((key, form.format(name=name)) for key, names in NAMES for name in names for form in STATEMENTS),
    *((key, f"SPDX-License-Identifier: {key}{more}") for key, _ in NAMES for more in ("", "-only", "-or-later")),
]

# (spelling, equivalent), of lower-case words without punctuation
SPELLINGS = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("sub licensing", "sublicensing"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("wilful", "willful"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("merchantibility", "merchantability"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
]
