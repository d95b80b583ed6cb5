"""inkmill.functions"""
