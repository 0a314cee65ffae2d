"""Published sample vocabulary of the English (Porter2) stemmer: word -> stem."""

CASES = dict(
    pair.split(":")
    for pair in """
    consign:consign consigned:consign consigning:consign consignment:consign consist:consist consisted:consist
    consistency:consist consistent:consist consistently:consist consisting:consist consists:consist
    consolation:consol consolations:consol consolatory:consolatori console:consol consoled:consol consoles:consol
    consolidate:consolid consolidated:consolid consolidating:consolid consoling:consol consolingly:consol consols:consol
    consonant:conson consort:consort consorted:consort consorting:consort conspicuous:conspicu conspicuously:conspicu
    conspiracy:conspiraci conspirator:conspir conspirators:conspir conspire:conspir conspired:conspir conspiring:conspir
    constable:constabl constables:constabl constance:constanc constancy:constanc constant:constant
    knack:knack knackeries:knackeri knacks:knack knag:knag knave:knave knaves:knave knavish:knavish kneaded:knead
    kneading:knead knee:knee kneel:kneel kneeled:kneel kneeling:kneel kneels:kneel knees:knee knell:knell knelt:knelt
    knew:knew knick:knick knif:knif knife:knife knight:knight knightly:knight knights:knight knit:knit knits:knit
    knitted:knit knitting:knit knives:knive knob:knob knobs:knob knock:knock knocked:knock knocker:knocker
    knockers:knocker knocking:knock knocks:knock knopp:knopp knot:knot knots:knot
    skies:sky dying:die early:earli news:news inning:inning running:run hopping:hop hoping:hope agreed:agre
    national:nation generous:generous communism:communism universities:univers cries:cri ties:tie gas:gas this:this
    hopeful:hope happy:happi say:say cry:cri by:by sky:sky learning:learn networks:network neural:neural
    classification:classif sensational:sensat relational:relat conditional:condit rational:ration vietnamization:vietnam
    hesitancy:hesit digitizer:digit radically:radic operator:oper feudalism:feudal decisiveness:decis hopefulness:hope
    formality:formal sensitivity:sensit sensibility:sensibl triplicate:triplic formative:format electricity:electr
    goodness:good revival:reviv allowance:allow inference:infer airliner:airlin adjustable:adjust defensible:defens
    irritant:irrit replacement:replac dependent:depend adoption:adopt activate:activ bowdlerize:bowdler
    """.split()
)
