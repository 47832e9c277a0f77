"""Names and numbers that results must carry exactly as listed here."""

from __future__ import annotations

OCTET_STREAM = "application/octet-stream"
TEXT_PLAIN = "text/plain"
TEXT_HTML = "text/html"
XML = "application/xml"
XHTML = "application/xhtml+xml"
ZIP = "application/zip"
MESSAGE = "message/rfc822"
TEXT_MESSAGE = "text/x-tika-text-based-message"
OOXML = "application/x-tika-ooxml"
DOCX = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
XLSX = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"
PPTX = "application/vnd.openxmlformats-officedocument.presentationml.presentation"
EPUB = "application/epub+zip"
MSOFFICE = "application/x-tika-msoffice"

# Media type -> supertype. Types not listed follow the rules
# text/* -> text/plain, *+xml -> application/xml, anything else -> octet-stream.
SUPERTYPES = [
    (TEXT_PLAIN, OCTET_STREAM),
    (TEXT_HTML, TEXT_PLAIN),
    ("text/css", TEXT_PLAIN),
    ("text/csv", TEXT_PLAIN),
    ("text/tab-separated-values", TEXT_PLAIN),
    ("text/x-log", TEXT_PLAIN),
    ("text/x-web-markdown", TEXT_PLAIN),
    (TEXT_MESSAGE, TEXT_PLAIN),
    (MESSAGE, TEXT_MESSAGE),
    (XML, TEXT_PLAIN),
    (XHTML, XML),
    ("image/svg+xml", XML),
    ("application/javascript", TEXT_PLAIN),
    ("application/json", TEXT_PLAIN),
    ("application/rtf", TEXT_PLAIN),
    ("application/pdf", OCTET_STREAM),
    (ZIP, OCTET_STREAM),
    (OOXML, ZIP),
    (DOCX, OOXML),
    (XLSX, OOXML),
    (PPTX, OOXML),
    (EPUB, ZIP),
    ("application/gzip", OCTET_STREAM),
    ("application/x-bzip2", OCTET_STREAM),
    ("application/x-7z-compressed", OCTET_STREAM),
    ("application/x-tar", OCTET_STREAM),
    (MSOFFICE, OCTET_STREAM),
    ("application/msword", MSOFFICE),
    ("application/vnd.ms-excel", MSOFFICE),
    ("application/vnd.ms-outlook", MSOFFICE),
    ("application/mp4", OCTET_STREAM),
    ("video/mp4", "application/mp4"),
    ("video/quicktime", "application/mp4"),
    ("audio/mpeg", OCTET_STREAM),
    ("audio/vnd.wave", OCTET_STREAM),
    ("image/bmp", OCTET_STREAM),
    ("image/gif", OCTET_STREAM),
    ("image/jpeg", OCTET_STREAM),
    ("image/png", OCTET_STREAM),
    ("image/tiff", OCTET_STREAM),
    ("image/vnd.adobe.photoshop", OCTET_STREAM),
    ("image/webp", OCTET_STREAM),
]

# Media type -> file extensions.
GLOBS = [
    (TEXT_PLAIN, ["txt", "text"]),
    (TEXT_HTML, ["html", "htm"]),
    ("text/css", ["css"]),
    ("text/csv", ["csv"]),
    ("text/tab-separated-values", ["tsv"]),
    ("text/x-log", ["log"]),
    ("text/x-web-markdown", ["md", "mdtext", "mkd", "markdown"]),
    (MESSAGE, ["eml", "mime", "mht", "mhtml"]),
    (XML, ["xml", "xsl", "xsd"]),
    (XHTML, ["xhtml", "xht"]),
    ("image/svg+xml", ["svg"]),
    ("application/javascript", ["js"]),
    ("application/json", ["json"]),
    ("application/rtf", ["rtf"]),
    ("application/pdf", ["pdf"]),
    (ZIP, ["zip"]),
    (DOCX, ["docx"]),
    (XLSX, ["xlsx"]),
    (PPTX, ["pptx"]),
    (EPUB, ["epub"]),
    ("application/gzip", ["gz", "tgz", "tar.gz"]),
    ("application/x-bzip2", ["bz2", "tbz2", "tar.bz2"]),
    ("application/x-7z-compressed", ["7z"]),
    ("application/x-tar", ["tar"]),
    ("application/msword", ["doc", "dot"]),
    ("application/vnd.ms-excel", ["xls", "xlt"]),
    ("application/vnd.ms-outlook", ["msg"]),
    ("video/mp4", ["mp4", "m4v"]),
    ("video/quicktime", ["mov", "qt"]),
    ("audio/mpeg", ["mp3", "mpga"]),
    ("audio/vnd.wave", ["wav"]),
    ("image/bmp", ["bmp", "dib"]),
    ("image/gif", ["gif"]),
    ("image/jpeg", ["jpg", "jpeg", "jpe"]),
    ("image/png", ["png"]),
    ("image/tiff", ["tiff", "tif"]),
    ("image/vnd.adobe.photoshop", ["psd"]),
    ("image/webp", ["webp"]),
]

# Fixed values: "offset:signature bytes in hex" (all of them must match), media type, priority.
MAGIC = [
    ("0:255044462D", "application/pdf", 50),
    ("0:25504446", "application/pdf", 40),
    ("0:504B0304", ZIP, 40),
    ("0:504B0506", ZIP, 40),
    ("0:1F8B", "application/gzip", 45),
    ("0:89504E470D0A1A0A", "image/png", 50),
    ("0:FFD8FF", "image/jpeg", 50),
    ("0:47494638", "image/gif", 50),
    ("0:49492A00", "image/tiff", 50),
    ("0:4D4D002A", "image/tiff", 50),
    ("0:52494646 8:57454250", "image/webp", 50),
    ("0:52494646 8:57415645", "audio/vnd.wave", 50),
    ("0:494433", "audio/mpeg", 50),
    ("0:FFFB", "audio/mpeg", 40),
    ("4:667479707174", "video/quicktime", 60),
    ("4:66747970", "application/mp4", 50),
    ("0:D0CF11E0A1B11AE1", MSOFFICE, 50),
    ("0:7B5C727466", "application/rtf", 50),
    ("0:425A68", "application/x-bzip2", 40),
    ("0:377ABCAF271C", "application/x-7z-compressed", 50),
    ("257:7573746172", "application/x-tar", 40),
    ("0:424D", "image/bmp", 30),
    ("0:38425053", "image/vnd.adobe.photoshop", 50),
    ("0:EFBBBF", TEXT_PLAIN, 10),
    ("0:FFFE", TEXT_PLAIN, 10),
    ("0:FEFF", TEXT_PLAIN, 10),
]

# Member names that tell one ZIP-based format from another.
# Main part and folder of each package format, by the names in the archive's directory.
PACKAGE_NAMES = [
    ("word/document.xml", "word/", DOCX),
    ("xl/workbook.xml", "xl/", XLSX),
    ("ppt/presentation.xml", "ppt/", PPTX),
]
OOXML_NAME = "[Content_Types].xml"

# Error classes carried by the error column.
PARSE_ERROR = "PARSE_ERROR"
INVALID_MEDIA_TYPE = "INVALID_MEDIA_TYPE"
INVALID_ARGUMENT = "INVALID_ARGUMENT"
INVALID_INPUT = "INVALID_INPUT"
INPUT_NOT_FOUND = "INPUT_NOT_FOUND"
INVALID_OUTPUT_FORMAT = "INVALID_OUTPUT_FORMAT"

OUTPUT_FORMATS = ("txt", "xhtml")

# Raw metadata keys written by the extractors.
RESOURCE_NAME = "resourceName"
CONTENT_TYPE = "Content-Type"
CONTENT_TYPE_OVERRIDE = "Content-Type-Override"
CONTENT_LENGTH = "Content-Length"
CONTENT_ENCODING = "Content-Encoding"
PARSED_BY = "X-TIKA:Parsed-By"
EMBEDDED_DEPTH = "X-TIKA:embedded_depth"
EMBEDDED_RELATIONSHIP_ID = "embeddedRelationshipId"

# Normalised metadata field, type, raw keys in order of preference.
METADATA_FIELDS = [
    ("encoding", "string", ["Content-Encoding", "X-TIKA:detectedEncoding", "Encoding", "encoding", "charset"]),
    ("compression", "string", ["Compression CompressionTypeName", "Compression", "xmpDM:audioCompressor",
                               "xmpDM:videoCompressor", "Compressor ID"]),
    ("paragraph_count", "bigint", ["meta:paragraph-count"]),
    ("revision", "string", ["cp:revision"]),
    ("word_count", "bigint", ["meta:word-count"]),
    ("line_count", "bigint", ["meta:line-count"]),
    ("character_count", "bigint", ["meta:character-count"]),
    ("character_count_with_spaces", "bigint", ["meta:character-count-with-spaces"]),
    ("page_count", "bigint", ["meta:page-count", "xmpTPg:NPages", "exif:PageCount"]),
    ("chars_per_page", "bigint", ["pdf:charsPerPage"]),
    ("table_count", "bigint", ["meta:table-count", "Number of Tables"]),
    ("component_count", "bigint", ["Number of Components"]),
    ("image_count", "bigint", ["meta:image-count"]),
    ("hidden_slides", "string", ["extended-properties:HiddenSlides"]),
    ("resource_name", "string", ["resourceName", "File Name"]),
    ("embedded_resource_type", "string", ["embeddedResourceType"]),
    ("embedded_relationship_id", "string", ["embeddedRelationshipId"]),
    ("embedded_depth", "bigint", ["X-TIKA:embedded_depth"]),
    ("created", "string", ["dcterms:created", "pdf:docinfo:created", "fs:created"]),
    ("modified", "string", ["dcterms:modified", "pdf:docinfo:modified", "fs:modified", "fs:created",
                            "File Modification Date/Time", "File Inode Change Date/Time"]),
    ("content_type", "string", ["Content-Type"]),
    ("content_type_override", "string", ["Content-Type-Override"]),
    ("content_length", "bigint", ["Content-Length"]),
    ("title", "string", ["dc:title", "pdf:docinfo:title", "dc:subject", "pdf:docinfo:subject", "Title"]),
    ("description", "string", ["dc:description"]),
    ("type", "string", ["dc:type"]),
    ("keywords", "array<string>", ["meta:keyword", "dc:subject", "pdf:docinfo:keywords"]),
    ("company", "string", ["extended-properties:Company"]),
    ("creator", "string", ["dc:creator", "meta:last-author", "pdf:docinfo:creator", "pdf:docinfo:producer",
                           "Artist"]),
    ("publisher", "string", ["dc:publisher"]),
    ("contributor", "string", ["dc:contributor"]),
    ("language", "string", ["dc:language"]),
    ("identifier", "string", ["dc:identifier"]),
    ("application", "string", ["extended-properties:Application", "pdf:docinfo:creator_tool", "tiff:Software",
                               "xmpMM:History:SoftwareAgent", "Software", "vendor"]),
    ("application_version", "string", ["extended-properties:AppVersion", "version"]),
    ("producer", "string", ["pdf:producer"]),
    ("version", "string", ["pdf:PDFVersion", "epub:version"]),
    ("template", "string", ["extended-properties:Template"]),
    ("security", "string", ["None", "PasswordProtected", "ReadOnlyEnforced", "ReadOnlyRecommended",
                            "LockedForAnnotations", "Unknown", "extended-properties:DocSecurity",
                            "extended-properties:DocSecurityString"]),
    ("is_encrypted", "string", ["pdf:encrypted", "PasswordProtected"]),
    ("height", "bigint", ["tiff:ImageLength", "height", "Image Height", "Source Image Height"]),
    ("width", "bigint", ["tiff:ImageWidth", "width", "Image Width", "Source Image Width"]),
    ("duration", "double", ["xmpDM:duration", "Duration"]),
    ("stream_count", "bigint", ["Stream Count"]),
    ("image_pixel_aspect_ratio", "double", ["xmpDM:videoPixelAspectRatio"]),
    ("image_color_space", "string", ["xmpDM:videoColorSpace"]),
    ("audio_channels", "bigint", ["xmpDM:audioChannelType", "channels"]),
    ("audio_bits", "bigint", ["bits"]),
    ("audio_sample_type", "string", ["xmpDM:audioSampleType"]),
    ("video_frame_rate", "double", ["xmpDM:videoFrameRate"]),
    ("video_codec", "string", ["Video Codec"]),
    ("video_frame_count", "bigint", ["Frame Count"]),
    ("from_", "string", ["Message-From", "Message:From-Email", "Message:From-Name"]),
    ("to", "string", ["Message-To", "Message:To-Email", "Message:To-Name", "Message:To-Display-Name",
                      "Message-Recipient-Address"]),
    ("cc", "string", ["Message-Cc", "Message:CC-Email", "Message:CC-Name", "Message:CC-Display-Name"]),
    ("bcc", "string", ["Message-Bcc", "Message:BCC-Email", "Message:BCC-Name", "Message:BCC-Display-Name"]),
    ("multipart_subtypes", "string", ["Multipart-Subtype"]),
    ("multipart_boundary", "string", ["Multipart-Boundary"]),
]

# Declared fields without a raw key; always NULL.
UNMAPPED_FIELDS = [("resource_path", "string"), ("sample_rate", "bigint"), ("audio_encoding", "string")]

# Package part -> (XML element, raw key).
CORE_PROPERTIES = [
    ("dc:title", "dc:title"),
    ("dc:subject", "dc:subject"),
    ("dc:creator", "dc:creator"),
    ("dc:description", "dc:description"),
    ("dc:language", "dc:language"),
    ("dc:identifier", "dc:identifier"),
    ("dc:publisher", "dc:publisher"),
    ("cp:keywords", "meta:keyword"),
    ("cp:lastModifiedBy", "meta:last-author"),
    ("cp:revision", "cp:revision"),
    ("dcterms:created", "dcterms:created"),
    ("dcterms:modified", "dcterms:modified"),
]
APP_PROPERTIES = [
    ("Words", "meta:word-count"),
    ("Pages", "meta:page-count"),
    ("Lines", "meta:line-count"),
    ("Paragraphs", "meta:paragraph-count"),
    ("Characters", "meta:character-count"),
    ("CharactersWithSpaces", "meta:character-count-with-spaces"),
    ("Application", "extended-properties:Application"),
    ("AppVersion", "extended-properties:AppVersion"),
    ("Company", "extended-properties:Company"),
    ("Template", "extended-properties:Template"),
    ("DocSecurity", "extended-properties:DocSecurity"),
    ("HiddenSlides", "extended-properties:HiddenSlides"),
]

# Message header -> raw key.
MESSAGE_HEADERS = [
    ("From", "Message-From"),
    ("To", "Message-To"),
    ("Cc", "Message-Cc"),
    ("Bcc", "Message-Bcc"),
    ("Subject", "dc:title"),
    ("Subject", "dc:subject"),
    ("Date", "dcterms:created"),
]

# Confidence level -> lowest score.
CONFIDENCE_HIGH = 0.9
CONFIDENCE_MEDIUM = 0.7
