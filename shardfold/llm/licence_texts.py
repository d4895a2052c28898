"""Wording of licences: titles, grants, conditions and notices.

Each entry is a unit that stands by itself in files: a line, a paragraph or a
short licence as a whole.  A paragraph that two licences share stands under
the one that has less text; ``EXTENDS`` names the other.
"""

from __future__ import annotations

#: grants nothing, so it yields to any licence that is declared beside it
RESERVED = "Proprietary"

# fixed values: texts of the licences
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
)
_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_1 = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = ("2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
          "in the documentation and/or other materials provided with the distribution.")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
          "without specific prior written permission.")
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
    "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GPL_HEADER = ("This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by "
               "the Free Software Foundation, either version {n} of the License, or (at your option) any later version.")

#: fixed values: licence to the wording by which it is declared; the first entry of each is its usual notice
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
        "2. Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, "
        "no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, "
        "and distribute the Work and such Derivative Works in Source or Object form.",
    ],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
            "SPDX-License-Identifier: MIT", "MIT License", "The MIT License (MIT)", *_MIT, " ".join(_MIT)],
    "ISC": ["Released under the ISC License.", "SPDX-License-Identifier: ISC", *_ISC, " ".join(_ISC)],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
        _GPL_HEADER.format(name="GNU General Public License", n=3),
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended to guarantee "
        "your freedom to share and change free software--to make sure the software is free for all its users.",
        _GPL_HEADER.format(name="GNU General Public License", n=2),
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        _GPL_HEADER.format(name="GNU Lesser General Public License", n=3),
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        _GPL_HEADER.format(name="GNU Affero General Public License", n=3),
    ],
    "BSD-2-Clause": [
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
        _BSD_GRANT, _BSD_1, _BSD_2, _BSD_DISCLAIMER,
        " ".join((_BSD_GRANT, _BSD_1, _BSD_2, _BSD_DISCLAIMER)),
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        _BSD_3,
        " ".join((_BSD_GRANT, _BSD_1, _BSD_2, _BSD_3, _BSD_DISCLAIMER)),
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Mozilla Public License Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Released under CC0 1.0.", "This work is dedicated to the public domain under CC0 1.0 Universal."],
    RESERVED: ["All rights reserved.", "All rights reserved. No license is granted."],
}

#: a licence to the one whose paragraphs it holds besides its own: where both are declared, the longer one counts
EXTENDS = {"BSD-3-Clause": "BSD-2-Clause"}
