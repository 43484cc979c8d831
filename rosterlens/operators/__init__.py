"""DataFrame operators of directory quality."""
