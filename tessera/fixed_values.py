"""Patterns, formats and word lists that must equal the
reference's for the results to be equal. They are stated here together, in
the order the reference's programs use them; the modules import them."""

# ---- record parsing
MISSING_INT = -1                       # blank, "NA" or unparsable integer
NA = "NA"
FLIGHT_SEPARATOR = r"\s*,\s*"          # flight lines are split on commas with spaces
FLIGHT_HEADER_FIRST_FIELD = "Year"
FLIGHT_FIELDS = 29
AIRPORT_HEADER = r'^\s*"iata"\s*,.*'
AIRPORT_LINE = (r'^\s*"([^"]+)"\s*,\s*"([^"]+)"\s*,\s*"?([^"]+)"?\s*,\s*"?([^"]+)"?\s*,'
                r'\s*"([^"]+)"\s*,\s*([-.\d]+)\s*,\s*([-.\d]+)\s*$')
CARRIER_HEADER = r"^\s*Code\s*,.*"
CARRIER_LINE = r'^\s*"([^"]+)"\s*,\s*"([^"]+)"\s*$'
PLANE_HEADER = r"^\s*tailnum\s*,.*"
PLANE_TAIL_ONLY = r"^\s*(N\w+)\s*$"
PLANE_LINE = (r"^\s*(N[^,]+)\s*,\s*([^,]+)\s*,\s*([^,]+)\s*,\s*([^,]+)\s*,\s*([^,]+)\s*,"
              r"\s*([^,]+)\s*,\s*([^,]+)\s*,\s*([^,]+)\s*,\s*(\S+)\s*$")
PLANE_NO_YEAR = "None"
ABBREV_LINE = r"^\s*([^,]+)\s*\t\s*(.*)$"
PAIR_LINE = r"^\s*\(([^,]+),(.*)\)\s*$"
RATING_SEPARATOR = "::"
GENRE_SEPARATOR = r"\|"                # a literal bar (the reference's "|" split characters)
VECTOR_SEPARATOR = " "

# names and places of the record fields (0-based places in a flight line)
DATE_FIELDS = ["year", "month", "dayOfMonth", "dayOfWeek"]
TIMES_FIELDS = [("depTime", 4), ("crsDepTime", 5), ("arrTime", 6), ("crsArrTime", 7),
                ("actualElapsedTime", 11), ("crsElapsedTime", 12), ("airTime", 13),
                ("arrDelay", 14), ("depDelay", 15), ("taxiIn", 19), ("taxiOut", 20)]
FLIGHT_TAIL_FIELDS = [("canceled", 21), ("cancellationCode", 22), ("diverted", 23), ("carrierDelay", 24),
            ("weatherDelay", 25), ("nasDelay", 26), ("securityDelay", 27),
            ("lateAircraftDelay", 28)]
PLANE_FIELDS = ["tailNum", "kind", "manufacturer", "issueDate", "model", "status",
                "aircraftType", "engineType"]

# ---- dates
DATE_PART_SEPARATOR = r"\s*[^\d]+\s*"
DATE_TIME_SEPARATOR = r"\s+"
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DATE_LABEL_FORMAT = "%4d-%02d-%02d (%s)"

# ---- text
WORD_SPLIT = r"\W+"                    # word count tokenizer
INDEX_SPLIT = r"[^\w']"                # inverted index tokenizer, one separator at a time
INDEX_TOKEN_CHAR = r"[\w']"            # what INDEX_SPLIT leaves
CRAWL_LINE_BREAK = r"\s*\n\s*"         # a line break with its surrounding spaces -> " "
TOKENIZER_LEAKS = ["", "'", "_"]       # always treated as stop words
POSTING_FORMAT = "(%s,%d)"
POSTING_SEPARATOR = ", "

# ---- streams, ETL, graph, sentiment
NUMBER_SEPARATOR = r"\s+"
ETL_SEPARATOR = "|"
ETL_PARTITION_FORMATS = ("%04d", "%02d", "%02d")   # depYear, depMonth, depDay
ROUTE_FORMAT = "%s -> %s: %d"
WORD_SEPARATOR = " "                   # sentiment features: one space, no lowercasing
STREAM_KEYWORDS = ("programming", "computer", "crash")
