"""Tables kept on disk and brought up to date in part."""
