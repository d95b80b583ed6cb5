"""inkmill.streaming"""
