"""Labelled paragraphs for the licence classifier, and one template set per
family. Short notices and key sentences of well-known public licences; the
last two classes are licence-like text of no family, and ordinary text that
uses licence words. Words without meaning of their own (``STOP_WORDS``) are no
feature by themselves."""

#: Common words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
a an and any are as at be been by can could do does for from had has have he her his i if in into is it its may more my no
not of on one or other our out she shall so some such than that the their them then there these they this to under up use was
we were what when where which who will with would you your
als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im ist mit nach
nicht noch nur oder sich sie sind so um und unter von vor war wie wir zu zum zur
au aux avec ce ces cette dans de des du elle en est et il la le les leur mais ne ou où par pas plus pour qu que qui sa se ses
son sont sous sur un une
al bajo como con del donde el ella entre era es esta este ha hay las lo los más me muy ni nos o para pero por se ser si sin
sobre su sus también todo un una y ya
""".split()) - {"mit", "sa"}  # names in licences

TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
        "Lizenziert unter der Apache-Lizenz, Version 2.0.",
        "Sous licence Apache, version 2.0.",
        "Bajo la licencia Apache, versión 2.0.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "This code is MIT licensed.",
        "Distributed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Licensed under the MIT/X11 terms.",
        "The software is provided \"as is\", without warranty of any kind.",
        "THE SOFTWARE IS PROVIDED \"AS IS\"",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY.",
        "Veröffentlicht unter der MIT-Lizenz.",
        "Publié sous licence MIT.",
        "Publicado bajo la licencia MIT.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GPL v3 license.",
        "Licensed under the GNU GPL, version 3 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Lizenziert unter der GNU GPL, Version 3.",
        "Sous licence publique générale GNU, version 3.",
        "Bajo la licencia pública general de GNU, versión 3.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "Released under the LGPL license, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "agpl-3.0": [
        "This program is free software: you can redistribute it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3.",
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL v3 license.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Neither the name of the University nor the names of its contributors may be used to endorse or promote products.",
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Except where otherwise noted, content is available under the CC BY-NC 4.0 license.",
        "You may not use the material for commercial purposes. Creative Commons Attribution-NonCommercial.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "Licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Content is available under the Creative Commons Attribution license.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "public-domain": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
        "Licensed under CC0 1.0.",
        "This work is dedicated to the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "proprietary": [
        "All rights reserved.",
        "Alle Rechte vorbehalten.",
        "Tous droits réservés.",
        "Todos los derechos reservados.",
        "Copyright 2020 Example Inc. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher.",
        "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
        "Copyright (c) 2019 The Author. All rights reserved. Do not redistribute.",
    ],
}

#: Licence-like paragraphs of no known family.
UNKNOWN = [
    "Licensed under the terms in the accompanying agreement.",
    "This work is licensed under a custom agreement between the parties.",
    "Use of this file is subject to the licence agreement of the vendor.",
    "You may copy this text for your own use if you keep this notice.",
    "Distributed under the terms of the artistic licence.",
    "Released under the Do What You Want public license, version 2.",
    "Licensed under the Eclipse Public License, version 1.",
    "Licensed under the European Union Public Licence, version 1.2.",
    "This software is licensed under the zlib license.",
    "Permission is granted to copy this document verbatim for classroom use.",
    "The licensee shall not sublicense the product without consent of the licensor.",
    "Provided without warranty of fitness under the vendor licence.",
    "This work is licensed under the university data licence, version 1.",
    "Copying and distribution of this file are permitted under the site's own terms.",
]

#: Ordinary text with words that licences use.
NONE = [
    "He lost his driving licence in the spring.",
    "The pilot asked for permission to land.",
    "The warranty on the kettle ran out in May.",
    "A licence fee is due for every television set.",
    "She got permission to use the hall for any purpose.",
    "The copyright dispute between the two papers went on for years.",
    "Version 3 of the engine was louder than version 2.",
    "The general public was admitted free of charge.",
    "The Apache helicopter landed at noon.",
    "Students of MIT built a small car.",
    "The state may redistribute the money under a new law.",
    "They were licensed to sell wine and beer.",
    "A fishing license is sold at the harbour.",
    "The rights of the workers were reserved for later talks.",
    "The public domain is larger than people think.",
    "The new attribution of the painting to his pupil surprised the museum.",
    "The commercial license of the station was renewed under protest.",
    "The software was useful but the warranty was not.",
    "The work is in the house of the author.",
    "The distribution of the seats is as follows.",
]
