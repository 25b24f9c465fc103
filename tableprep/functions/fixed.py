"""Fixed values of the SQL-on-Hadoop dialect and of the character profile."""

# Keywords that may be used as identifiers only with care (non-reserved).
NON_RESERVED_KEYWORDS = (
    "ADD ADMIN AFTER ANALYZE ARCHIVE ASC BEFORE BUCKET BUCKETS CASCADE CHANGE CLUSTER CLUSTERED CLUSTERSTATUS "
    "COLLECTION COLUMNS COMMENT COMPACT COMPACTIONS COMPUTE CONCATENATE CONTINUE DATA DATABASES DATETIME DAY "
    "DBPROPERTIES DEFERRED DEFINED DELIMITED DEPENDENCY DESC DIRECTORIES DIRECTORY DISABLE DISTRIBUTE ELEM_TYPE "
    "ENABLE ESCAPED EXCLUSIVE EXPLAIN EXPORT FIELDS FILE FILEFORMAT FIRST FORMAT FORMATTED FUNCTIONS HOLD_DDLTIME "
    "HOUR IDXPROPERTIES IGNORE INDEX INDEXES INPATH INPUTDRIVER INPUTFORMAT ITEMS JAR KEYS KEY_TYPE LIMIT LINES LOAD "
    "LOCATION LOCK LOCKS LOGICAL LONG MAPJOIN MATERIALIZED MINUS MINUTE MONTH MSCK NOSCAN NO_DROP OFFLINE OPTION "
    "OUTPUTDRIVER OUTPUTFORMAT OVERWRITE OWNER PARTITIONED PARTITIONS PLUS PRETTY PRINCIPALS PROTECTION PURGE READ "
    "READONLY REBUILD RECORDREADER RECORDWRITER REGEXP RELOAD RENAME REPAIR REPLACE RESTRICT REWRITE RLIKE ROLE ROLES "
    "SCHEMA SCHEMAS SECOND SEMI SERDE SERDEPROPERTIES SERVER SETS SHARED SHOW SHOW_DATABASE SKEWED SORT SORTED SSL "
    "STATISTICS STORED STREAMTABLE STRING STRUCT TABLES TBLPROPERTIES TEMPORARY TERMINATED TINYINT TOUCH TRANSACTIONS "
    "UNARCHIVE UNDO UNIONTYPE UNLOCK UNSET UNSIGNED URI USE UTC UTCTIMESTAMP VALUE_TYPE VIEW WHILE YEAR"
).split()

# Keywords that cannot be used as identifiers (reserved).
RESERVED_KEYWORDS = (
    "ALL ALTER AND ARRAY AS AUTHORIZATION BETWEEN BIGINT BINARY BOOLEAN BOTH BY CASE CAST CHAR COLUMN CONF CREATE "
    "CROSS CUBE CURRENT CURRENT_DATE CURRENT_TIMESTAMP CURSOR DATABASE DATE DECIMAL DELETE DESCRIBE DISTINCT DOUBLE "
    "DROP ELSE END EXCHANGE EXISTS EXTENDED EXTERNAL FALSE FETCH FLOAT FOLLOWING FOR FROM FULL FUNCTION GRANT GROUP "
    "GROUPING HAVING IF IMPORT IN INNER INSERT INT INTERSECT INTERVAL INTO IS JOIN LATERAL LEFT LESS LIKE LOCAL MACRO "
    "MAP MORE NONE NOT NULL OF ON OR ORDER OUT OUTER OVER PARTIALSCAN PARTITION PERCENT PRECEDING PRESERVE PROCEDURE "
    "RANGE READS REDUCE REGEXP REVOKE RIGHT RLIKE ROLLUP ROW ROWS SELECT SET SMALLINT TABLE TABLESAMPLE THEN "
    "TIMESTAMP TO TRANSFORM TRIGGER TRUE TRUNCATE UNBOUNDED UNION UNIQUEJOIN UPDATE USER USING VALUES VARCHAR WHEN "
    "WHERE WINDOW WITH"
).split()

# Three-wide names of the control characters 0-31 and of the space.
CONTROL_LABELS = (
    "nul", "SOH", "STX", "ETX", "EOT", "ENQ", "ACK", "BEL", " BS", "tab", " lf", " VT", " FF", " cr", " SO", " SI",
    "DLE", "DC1", "DC2", "DC3", "DC4", "NAK", "SYN", "ETB", "CAN", " EM", "SUB", "ESC", " FS", " GS", " RS", " US",
    " sp",
)

# Labels of the buckets above the single characters, bucket 256 first.
CLASS_LABELS = ("2Hi", "Ndg", "Let", "Dig", "typ", "NTP", "NAN", "NTS", "L- ", "NL-")

TOO_HIGH = 256  # bucket of every character above 255

# Fixed value: schema comment that marks a currency column.
MONEY_COMMENT = "dollars and cents with decimal point"

# Fixed value: bytes aimed at per output file.
TARGET_FILE_BYTES = 256_000_000

# Fixed value: what a masked value looks like.
MASK = "XXXXXXXX"


def bucket_label(bucket: int) -> str:
    """Three-wide label of a bucket: control names, the Windows-1252 glyph of a byte, or a class name."""
    if bucket < len(CONTROL_LABELS):
        return CONTROL_LABELS[bucket]
    if bucket >= TOO_HIGH:
        return CLASS_LABELS[bucket - TOO_HIGH]
    glyph = chr(bucket) if bucket < 128 else bytes([bucket]).decode("cp1252", errors="replace")
    return ("" if glyph == "�" else glyph).rjust(3)
