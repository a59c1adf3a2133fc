"""Names, codes and defaults that results depend on."""

# Change-row status codes.
STATUS_UPDATED = "u"
STATUS_DELETED = "d"

# Property names (prefix:local) the document builder treats specially.
NAME = "cm:name"
OWNER = "cm:owner"
CREATOR = "cm:creator"
MODIFIER = "cm:modifier"
CREATED = "cm:created"
MODIFIED = "cm:modified"
CONTENT = "cm:content"
CONTENT_TRANSFORM_STATUS = "cm:content.tr_status"
STORE_IDENTIFIER = "sys:store-identifier"

# Names of the written document fields.
FIELD_TYPE = "TYPE"
FIELD_PRIMARY_PARENT = "PRIMARYPARENT"
FIELD_PARENTS = "PARENT"
FIELD_READERS = "READER"
FIELD_LAST_UPDATE = "METADATA_INDEXING_LAST_UPDATE"
FIELD_OWNER = "OWNER"
FIELD_PROPERTY_NAMES = "PROPERTIES"
FIELD_ASPECTS = "ASPECT"
FIELD_TAGS = "TAG"
FIELD_ALIVE = "ALIVE"
FIELD_CONTENT_MIME = "cm%3Acontent%2Emimetype"
FIELD_CONTENT_SIZE = "cm%3Acontent%2Esize"
FIELD_CONTENT_ENCODING = "cm%3Acontent%2Eencoding"
FIELD_CONTENT_TEXT = "cm%3Acontent"
FIELD_CONTENT_ID = "contentId"

# Members of the content property and of localised values.
CONTENT_ID = "contentId"
CONTENT_MIME = "mimetype"
CONTENT_SIZE = "size"
CONTENT_ENCODING = "encoding"
LOCALE = "locale"
LOCALE_VALUE = "value"
REFERENCE_ID = "id"

# First element of a tag path, and the store whose text is indexed.
TAG_ROOT = "Tags"
LIVE_STORE = "SpacesStore"

# Operating defaults.
DEFAULT_MAX_TRANSACTIONS = 100
DEFAULT_CYCLE_SECONDS = 12
