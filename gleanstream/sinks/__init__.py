"""Writers: the message log, the posting collection, the published snapshot."""
