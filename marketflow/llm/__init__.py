"""Training-data operators: quality, deduplication, packing, tokens, pages, archives, licences and chats.

Nothing else in the package imports this subpackage.
"""
