"""Notices, headers and licence texts by SPDX identifier. the
wording of the public licences. ``licence_files`` has whole texts; a text that
is the same for "only" and "or later" stands for the latter."""

from pathlib import Path

NOTICES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ],
    "BSD-3-Clause": [
        "Released under the 3-clause BSD license.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.""",
    ],
    "BSD-2-Clause": [
        "Released under the 2-clause BSD license.",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    ],
    "ISC": [
        "Released under the ISC License.",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ],
    "GPL-2.0-or-later": [
        "Licensed under the GNU General Public License, version 2.",
        "This work is licensed under the GNU General Public License, version 2.",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
        version.""",
    ],
    "GPL-3.0-or-later": [
        "Licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version.""",
    ],
    "LGPL-2.1-or-later": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any
        later version.""",
    ],
    "LGPL-3.0-or-later": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.""",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.""",
    ],
    "AGPL-3.0-or-later": [
        "Licensed under the GNU Affero General Public License, version 3.",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.""",
    ],
    "GPL-2.0-only": [
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
        License version 2 as published by the Free Software Foundation.""",
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation; version 2 of the License only.""",
    ],
    "GPL-3.0-only": [
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, version 3.""",
    ],
    "LGPL-2.1-only": [
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; version 2.1.""",
    ],
    "LGPL-3.0-only": [
        """This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation, version 3.""",
    ],
    "AGPL-3.0-only": [
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General
        Public License as published by the Free Software Foundation, version 3.""",
    ],
    "MPL-2.0": [
        "Released under the Mozilla Public License, version 2.0.",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ],
    "Unlicense": [
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
    ],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
}
for _file in sorted(Path(__file__).with_name("licence_files").glob("*.txt")):
    NOTICES[_file.name.removesuffix(".txt")].insert(0, _file.read_text("utf-8"))
