"""Public licence texts and notices that scans compare with."""

TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details. You should have received a copy of the GNU General Public License along with this program. If not, see
https://www.gnu.org/licenses/.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "mit": "Released under the MIT License.",
    "mit-full": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "mpl-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means.""",
}

# -- built from the texts above

_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_GNU = TEMPLATES["gpl-3.0-header"]
TEMPLATES |= {
    "bsd-3-clause": TEMPLATES["bsd-2-clause"].replace("THIS SOFTWARE IS", _BSD_NAMES + "THIS SOFTWARE IS", 1),
    "agpl-3.0-header": _GNU.replace("GNU General", "GNU Affero General"),
    "gpl-2.0-header": _GNU.replace("version 3", "version 2"),
    "lgpl-2.1-header": _GNU.replace("GNU General", "GNU Lesser General").replace("program", "library").replace("version 3", "version 2.1"),
    "lgpl-3.0-header": _GNU.replace("GNU General", "GNU Lesser General"),
}

#: fixed values: identifiers of public licences and what notices call them
CALLED = {
    "agpl-3.0": ["GNU Affero General Public License v3.0", "GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3"],
    "apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"],
    "bsd": ["BSD License"],
    "bsd-2-clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"],
    "bsd-3-clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "BSD-3-Clause"],
    "bsl-1.0": ["Boost Software License, Version 1.0", "BSL-1.0"],
    "cc-by-3.0": ["Creative Commons Attribution 3.0 Unported License", "CC BY 3.0"],
    "cc-by-4.0": ["Creative Commons Attribution 4.0 International License", "CC BY 4.0"],
    "cc-by-nc-4.0": ["Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0"],
    "cc-by-nc-nd-4.0": ["Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "CC BY-NC-ND 4.0"],
    "cc-by-nc-sa-4.0": ["Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC BY-NC-SA 4.0"],
    "cc-by-nd-4.0": ["Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0"],
    "cc-by-sa-3.0": ["Creative Commons Attribution-ShareAlike 3.0 Unported License", "CC BY-SA 3.0"],
    "cc-by-sa-4.0": ["Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"],
    "cc0-1.0": ["CC0 1.0 Universal", "CC0 1.0"],
    "epl-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "EPL-2.0"],
    "gpl": ["GNU General Public License", "GPL"],
    "gpl-2.0": ["GNU General Public License v2.0", "GNU General Public License, version 2", "GPLv2", "GPL-2.0"],
    "gpl-3.0": ["GNU General Public License v3.0", "GNU General Public License, version 3", "GPLv3", "GPL-3.0"],
    "isc": ["ISC License"],
    "lgpl-2.1": ["GNU Lesser General Public License v2.1", "GNU Lesser General Public License, version 2.1", "LGPLv2.1", "LGPL 2.1", "LGPL-2.1"],
    "lgpl-3.0": ["GNU Lesser General Public License v3.0", "GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"],
    "mit": ["MIT License", "MIT"],
    "mpl-2.0": ["Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL-2.0"],
    "unlicense": ["Unlicense"],
    "zlib": ["zlib License"],
}
#: fixed values: how notices name a licence; what stands before these words is no part of a notice
FORMS = ["licensed under {}", "licensed under the {}", "licensed under a {}", "released under the {}", "distributed under the {}", "available under the {}", "under the terms of the {}"]


def notices() -> list[tuple[str, str]]:
    """(identifier, text) of the short notices: every form with every name, and the tag of the identifier itself."""
    spoken = [(key, form.format(name)) for key, names in CALLED.items() for name in names for form in FORMS]
    tags = [(key, f"SPDX-License-Identifier: {key}{end}") for key in CALLED for end in (["", "-only", "-or-later"] if "gpl-" in key else [""])]
    return spoken + tags


def all_templates() -> list[tuple[str, str]]:
    return [*TEMPLATES.items(), *notices()]
