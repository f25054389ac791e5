"""Fixed values that results depend on: tags, names, word lists, patterns, windows."""

from __future__ import annotations

# ---- revenue tags -------------------------------------------------------------------------
PUBLISHED = "cinoche"
ESTIMATE = "estimate"

LOCAL_TZ = "America/Toronto"

# ---- ids ----------------------------------------------------------------------------------
PROVISIONAL_BASE = 1_000_000_000
DOCUMENTARY_GENRE = 99

# ---- time-of-day bands: label, first second, last second (both inclusive) -----------------
BANDS = [
    ("11-14", 11 * 3600, 13 * 3600 + 59 * 60),
    ("14-18", 14 * 3600, 17 * 3600 + 59 * 60),
    ("18-2030", 18 * 3600, 20 * 3600 + 29 * 60),
    ("2030-24", 20 * 3600 + 30 * 60, 23 * 3600 + 59 * 60),
]
QUIET_START = "01:00"
QUIET_END = "09:30"

# ---- provider names -----------------------------------------------------------------------
CHAIN_THEATERS = [
    "Cinéma Cineplex Odeon Quartier Latin",
    "Cinéma Banque Scotia",
    "Cinéma Cineplex Odeon Saint-Bruno",
    "Cinéma Cineplex Kirkland (Colisée)",
    "Cinéma Cineplex Odéon Beauport",
    "Cinéma Cineplex Laval",
    "Cinéma Capitol Saint-Jean",
    "Cinéma StarCité Montréal",
    "Cinéma Famous Players Carrefour Angrignon",
    "Cinéma Cineplex Royalmount",
    "Cinéma Cineplex Forum et VIP",
    "Cineplex IMAX aux Galeries de la Capitale",
    "Cinéma StarCité Gatineau",
    "Cinéma Cineplex Odeon Sainte-Foy",
    "Cinéma Galaxy Sherbrooke",
    "Cinéma Cineplex Odeon Carrefour Dorion",
    "Cinéma Cineplex Odeon Brossard et VIP",
    "Cinéma Galaxy Victoriaville",
]
SEAT_GRID_THEATERS = [
    "Cinéma Élysée (Granby)",
    "Cinéma Odyssée",
    "Cinéma Triomphe",
    "Cinéma Du Cap",
    "Cinéma Fleur de Lys",
    "Cinéma Apéro Jonquière",
]
TICKETING_WITH_SEATS = [
    "Maison du Cinéma (Sherbrooke)",
    "La Maison du Cinéma (Sherbrooke)",
    "Maison du Cinema",
    "Cinéma Beaubien",
    "Cinéma du Parc",
    "Cinéma du Musée",
    "Cinéma Saint-Eustache",
]
TICKETING_WITHOUT_SEATS = [
    "Cinéma RGFM Drummondville",
    "Cinéma RGFM Joliette",
    "Cinéma RGFM Saint-Laurent (Sorel-Tracy)",
    "Cinéma Capitol Drummondville",
    "Cinéma RGFM Beloeil",
    "Cinéma Magog",
    "Cinéma Princess Cowansville",
]
DISPLAYING_SEATS = "displayingSeats"
NOT_DISPLAYING_SEATS = "notDisplayingSeats"

# ---- measuring windows, seconds relative to the start of the show -------------------------
PROVIDER_WINDOWS = {
    "cineentreprise": (-(7 * 60 + 15), 0),
    "cineplex": (12 * 60 + 30, 15 * 60 + 30),
    "webdev": (13 * 60 + 45, 16 * 60 + 45),
    "cinematheque": (-(7 * 60), -60),
}
DEFAULT_WINDOW = (12 * 60, 17 * 60)
TICKETING_WITH_SEATS_WINDOW = (729, 900)
MIN_WINDOW_SECONDS = 60
PROVIDER_PRIORITY = {"cineentreprise": 0, "cineplex": 1, "cinematheque": 2, "webdev": 3}
UNKNOWN_PRIORITY = 99

# ---- session areas ------------------------------------------------------------------------
GENERAL_AREA = "0000000001"
MOTION_SEAT_AREA = "0000000004"

# ---- French months ------------------------------------------------------------------------
FRENCH_MONTHS = {
    "janvier": 1, "fevrier": 2, "mars": 3, "avril": 4, "mai": 5, "juin": 6, "juillet": 7,
    "aout": 8, "septembre": 9, "octobre": 10, "novembre": 11, "decembre": 12,
}

# ---- title patterns ({B} word boundary, {L} and {R} left and right edge of a word; words are
# ---- ASCII letters, digits and underscore) -------------------------------------------------
NOISE_TOKENS = r"{L}(VF|VOA?|VOST(?:FR)?|IMAX|ATMOS|4DX|D-?BOX|HFR|3D|2D|Dolby(?:\s+Cinema)?){R}"
LEADING_ARTICLE = r"^(le|la|les|the|l|un|une)\s+"
BRACKETED = r"\([^)]*\)|\[[^\]]*\]"
# flag, capital letters any title with it contains, pattern
VERSION_FLAGS = [
    ("VF", "V", r"{L}V\.?F\.?{B}"),
    ("VOA", "V", r"{L}V\.?O\.?A?\.?{B}"),
    ("VOST", "VOST", r"{L}VOST(?:FR|A)?{R}"),
    ("IMAX", "IMAX", r"{L}IMAX{R}"),
    ("ATMOS", "ATMOS", r"{L}ATMOS{R}"),
    ("4DX", "4DX", r"{L}4DX{R}"),
    ("DBOX", "BOX", r"{L}D-?BOX{R}"),
    ("HFR", "HFR", r"{L}HFR{R}"),
    ("3D", "3D", r"{L}3D{R}"),
    ("2D", "2D", r"{L}2D{R}"),
]
AUDITORIUM_WORDS = r"{L}(salle|aud|auditorium|screen|vip){R}"
VERSION_MARKERS = [
    r"{L}V\.?F\.?(\s*Q|O?F)?{B}",
    r"{L}V\.?O\.?(S?T\.)?{B}",
    r"\s*\(\s*version\s+fran(?:ç|c)aise\s*\)\s*",
    r"\s*\(\s*vf(?:of)?\s*\)\s*",
    r"\s+vf(?:of)?\s*$",
]
VENUE_WORDS = r"(th[eé]âtre|cin[eé]|rgfm|guzzo|beaubien|forum|imax|vip)"
VENUE_OR_FORMAT_WORDS = r"(th[eé]âtre|cin[eé]|rgfm|guzzo|beaubien|forum|imax|vip|4d|d-box)"

# ---- markup: entities, attribute remains ({B} and \s as above) ----------------------------
ENTITIES = [("&apos;", "'"), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
# pattern, whether case counts
ATTRIBUTE_CRUMBS = [
    (r"{B}(?:data-[A-Za-z0-9_-]+|[a-zA-Z-]+-media)\s*=\s*\"\[[^\"]*\]\"\s*", True),
    (r";\s*[a-z-]+\s*:\s*[^;\"]+;?", True),
    (r"{B}visibility\s*:\s*hidden{B}", False),
    (r"{B}pos[0-9]+{B}", False),
]
MARKUP_REMAINS = [
    (r"\[[^\]]*\]\">?$", True),
    (r"[\"']\s*>?$", True),
    (r"{B}[a-z-]*media\s*=\s*[\"'][^\"']*[\"']", False),
    (r"{B}style\s*=\s*[\"'][^\"']*[\"']", False),
]

# ---- page records: class names and text patterns ------------------------------------------
BOX_OFFICE_SECTION = "box-office-wrapper"
BOX_OFFICE_ROW = "table-row"
FILM_INFO = "movie-infos"
WEEKEND_TOTAL = "is-week-end-total"
ALL_TIME_TOTAL = "is-all-time-total"
DAY_TAB = "days-slider-slide-trigger-content"
DAY_PARTS = ["days-slider-weekday", "days-slider-date", "days-slider-month"]
DAY_SECTION = "cinema-schedule-movies"
THEATER_ITEM = "theater-item"
THEATER_TITLE = "cinema-schedule-movie-title"
THEATER_SUBTITLE = "cinema-schedule-movie-subtitle"
SHOW_TIME = "cinema-schedule-movie-time"
OTHER_THEATER_TITLES = ["item-title", "item-title-link"]
OTHER_THEATER_SUBTITLES = ["item-subtitle", "theater-subtitle"]
OTHER_SHOW_TIMES = ["movie-time", "session-time"]
RELEASE_NOTE = "movie-schedule-next"
LANGUAGE_LINES = "movie-languages-content"
HALL_CARD, HALL_DAY, HALL_TIME, HALL_NAME = "list-item", "schedule-day-grid", "hour", "salle"
ORIGINAL_TITLE_IN_INFO = r"\(([^()]+)\s+-\s+V\.O\.A\."
ORIGINAL_TITLE_LABEL = r"(?i)titre\s+original\s*:?\s*([^|•<\n]{2,120})"
LANGUAGE_TITLE = r"(?i)(?:v\.?\s*o\.?\s*a?\.?[^:]*?|titre\s+original)[^:]*:\s*([^|•<\n]+)$"
PURCHASE_HEADER = (
    r"(?i)([A-Za-zéèêàîôûç ,'-]+-\s*[0-9]{1,2}[:hH][0-9]{2}\s*-\s*Salle\s*[A-Za-z0-9 ]+[^|]*?)(?=\s{2,}|$)"
)
SEATS_LEFT = r"(?i){B}places?[^0-9]{0,10}(?:disp\.?|disponibles?)\s*:\s*([0-9]+){B}"
HALL_IN_HEADER = r"(?i){B}Salle\s*([A-Za-z0-9 ]+){B}"
HALL_NUMBER = r"(?i){B}(salle|auditorium)\s*#?\s*([a-z0-9]+){B}"
SCHEDULE_NOISE = r"(?i){B}(?:VF|VO|VOA|VOSTA|VOSTFR|FR|ENG|IMAX|ATMOS|4DX|3D|2D){B}|{B}[0-9]{6}{B}"
TITLE_TAIL = r"\s*[–—\-|•·:,/]\s*$"
HEADING_MARKER = r'id="zrl_[0-9]+_A9"'
TITLE_CELLS = ("zrl_{row}_A37", "zrl_{row}_A35")
HIDDEN_KEY = "^[0-9]{5,}$"
SCHEDULE_CELLS = ("zrl_{row}_A{cell}", "tzzrl_{row}_A{cell}", "tzrl_{row}_A{cell}", "c-{row}-A{cell}")
BUTTON_IDS = ("c-{row}-A*", "zrl_{row}_A*")
HIDDEN_KEY_CELLS = ("zrl_{row}_A{cell}", "tzzrl_{row}_A{cell}", "tzrl_{row}_A{cell}")
HIDDEN_SCAN_RANGE = (2, 200)
PURCHASE_LINK = r'<a[^>]+href="[^"]*Film-achat\.awp[^"]*P3=[0-9]+[^"]*"[^>]*>'
STYLE_ANCHORS = ("margin-bottom:-1px",)
STYLED_HEADING = r'id="zrl_[0-9]+_(?:A8|A9)"'
FILM_LINK, FILM_TITLE = "movies-element-link", "movie-title"
