"""trialweave.streaming"""
